"""Language identification by compression.

For each language a dictionary is put together from a sample of its documents. A text
is compressed once per language with that dictionary as raw content, and the
language whose dictionary makes it smallest is chosen. The margin is the distance to
the second smallest as a share of it; a narrow margin rejects the text.

The sample is bounded: ``SAMPLE_TEXTS`` distinct texts per language, those with the
smallest hashes, which share the dictionary's ``DICTIONARY_BYTES`` evenly. A longer text gives a piece
that begins where its hash says. Counting and choosing run over all rows;
predictions compress whole texts. At most ``MAX_LANGUAGES`` dictionaries are broadcast; more
are an error.

Short texts differ by few bytes, so sizes are summed over two compression levels. Long ones
are compressed in pieces, each with the dictionary, because a long text is its own best
dictionary and margins would fade with length.
A tie goes to the language with more training rows, then to the name that sorts first.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and is rejected.
Rows without a language take no part in learning. With nothing to learn from every text is
``und``. Repeated rows are each reported. Other columns are ignored, or stay (``recognised``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopwright.llm.expr import unused
from shopwright.llm.grams import give_back
from shopwright.shared import stored

UNKNOWN = "und"
SAMPLE_TEXTS = 200
DICTIONARY_BYTES = 1 << 17
MAX_LANGUAGES = 500
PARTS = 64
LEVELS = (1, 6)
PIECE_BYTES = 1 << 14
MARGIN = 0.004

# Everything but the letters of Unicode.
_NO_LETTER = regex.compile(r"\P{L}+")


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def _prepared(text: str) -> bytes:
    """What is compressed: letters in lower case, everything else as single spaces."""
    return f" {_NO_LETTER.sub(' ', text).strip().lower()} ".encode()


def learn(
    docs: DataFrame, sample_texts: int = SAMPLE_TEXTS, dictionary_bytes: int = DICTIONARY_BYTES
) -> list[tuple[str, int, bytes]]:
    """(language, number of rows, dictionary) from text and lang, by falling number of rows."""
    rows = docs.select("lang", "text", F.xxhash64("text").alias("hash")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("lang") != UNKNOWN)
    )
    counts = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    # The smallest of each part of the hashes first, so that no task sees all texts of a language.
    chosen = rows.select("lang", "hash").distinct().withColumn("part", F.pmod("hash", F.lit(PARTS)))
    for keys in (["lang", "part"], ["lang"]):
        order = Window.partitionBy(*keys).orderBy("hash")
        chosen = chosen.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= sample_texts).drop("n")
    chosen = stored(chosen.select("lang", "hash"), "sampled")
    # A text's share of the dictionary, beginning at a place that its hash chooses.
    share = F.expr(f"{dictionary_bytes} div texts").cast("int")
    shares = chosen.groupBy("lang").agg(F.count("*").alias("texts")).select("lang", share.alias("share"))
    starts = F.pmod("hash", F.greatest(F.length("text") - F.col("share"), F.lit(0)) + 1).cast("int")
    # Bounded by languages x sample_texts rows of two numbers, and then of part of a text each.
    sample = (
        rows.join(F.broadcast(chosen), ["lang", "hash"])
        .join(F.broadcast(shares), "lang")
        .select("lang", "hash", F.substr("text", starts + 1, F.col("share")).alias("piece"), "share")
        .groupBy("lang", "hash", "share")
        .agg(F.min("piece").alias("piece"))
        .collect()
    )
    pieces: dict[str, list[bytes]] = {}
    for row in sorted(sample, key=lambda r: (r["lang"], r["hash"])):
        pieces.setdefault(row["lang"], []).append(_prepared(row["piece"])[1 : row["share"]])
    learned = [(r["lang"], r["count"], b" ".join(pieces.get(r["lang"], []))[:dictionary_bytes]) for r in counts]
    return sorted(learned, key=lambda x: (-x[1], x[0]))


def predict(
    docs: DataFrame,
    learned: list[tuple[str, int, bytes]],
    levels: tuple[int, ...] = LEVELS,
    names: tuple[str, str] = ("_lang_pred", "_margin"),
) -> DataFrame:
    """docs with two columns more, by default _lang_pred and _margin (0 to 1); ``names`` must be new."""
    place = docs.columns.index("text")
    known = docs.sparkSession.sparkContext.broadcast([(lang, content) for lang, _, content in learned])

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = [lang for lang, _ in known.value]
        packers = []
        for level in levels:
            row = []
            for _, content in known.value:
                own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                own.precompute_compress(level=level)
                row.append(
                    zstandard.ZstdCompressor(dict_data=own, write_content_size=False, write_checksum=False, write_dict_id=False)
                )
            packers.append(row)
        for batch in batches:
            found, margins = [], []
            for value in batch.column(place):
                text = _prepared(value.as_py() or "")
                if len(text) <= 2 or not langs:
                    found.append(UNKNOWN)
                    margins.append(0.0)
                    continue
                pieces = [text[i : i + PIECE_BYTES] for i in range(0, len(text), PIECE_BYTES)]
                sizes = np.array(
                    [sum(len(row[i].compress(p)) for row in packers for p in pieces) for i in range(len(langs))]
                )
                best = int(sizes.argmin())
                rest = np.delete(sizes, best)
                found.append(langs[best])
                margins.append(float((rest.min() - sizes[best]) / rest.min()) if len(rest) else 1.0)
            yield pa.record_batch(
                [*batch.columns, pa.array(found, pa.string()), pa.array(margins, pa.float64())],
                names=[*batch.schema.names, *names],
            )
        give_back()

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(predicted, f"{columns}, `{names[0]}` string, `{names[1]}` double")


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(~held_out(F.col("doc_id")))


def language_report(docs: DataFrame, margin: float = MARGIN) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (the margin), rejected (a narrow margin)."""
    found = predict(docs.select("doc_id", "text"), learn(training_rows(docs)))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("_lang_pred").alias("lang_pred"),
        F.col("_margin").alias("score"),
        (F.col("_margin") < margin).alias("rejected"),
    )


def recognised(docs: DataFrame, margin: float = MARGIN) -> DataFrame:
    """The documents whose language is clear enough, in the columns they came with."""
    names = (unused("_lang_pred", docs.columns), unused("_margin", docs.columns))
    kept = predict(docs, learn(training_rows(docs)), names=names).filter(F.col(names[1]) >= margin)
    return kept.select(*(f"`{c}`" for c in docs.columns))
