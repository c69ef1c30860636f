"""Harmonic packing of token sequences into sequences of one capacity.

The classes have the sizes capacity // 1, capacity // 2, capacity // 3, ...; class j takes j
pieces per sequence. A document is cut into pieces of exactly such sizes: as many whole
sequences as fit, then for what is left the largest class size that fits, again and again.
What is left shrinks quadratically, so a document has few small pieces, and a full sequence
of class j lacks less than j tokens, under one per cent for most classes.

Every worker fills sequences of its own for each class and holds back at most j - 1 pieces
of class j. The held-back pieces of all workers are numbered by class, which fills further
sequences; fewer than j pieces of class j remain in all, whatever the input's size, and
those are packed together, largest first. Token ids are checksummed where they are made
and pieces travel as a few numbers each.

Defined cases: a null or empty text has just the end id. Repeated rows are each packed.
Other columns than doc_id and text are ignored. An empty table gives no rows. Sequences are
padded to the capacity unless their length is a power of two.
"""

from __future__ import annotations

import functools
import itertools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopwright.llm.grams import give_back, small_batches
from shopwright.shared import stored

CAPACITY = 2048
END_ID = 1
KEPT_WORDS = 1_000_000
ROWS = 1_024


# A word that ends with an ASCII letter, and after it an ASCII punctuation mark and whatever is no letter or
# digit. Other letters may turn into a letter and a mark, which the vocabulary joins with the punctuation.
_TAIL = r"^(.*[A-Za-z])([!-/:-@\[-`{-~][^\s\pL\pN]*)$"


class WordEncoder:
    """Texts to token ids; every distinct word is tokenized once.

    Splitting texts at ASCII white space, and words between a letter and the punctuation at
    their end, agrees with the vocabulary's own rules, by which a token never spans
    either. ASCII words are looked up in lower case, which the vocabulary applies as well.

    Up to ``KEPT_WORDS`` words are kept, as one Arrow array, and forgotten together.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Strings of special tokens inside a text are ordinary text.
        self.tokenizer.encode_special_tokens = True
        self._forget()

    def _forget(self) -> None:
        # The ids of word number n are pool[ends[n] : ends[n + 1]]; number 0 is the empty word.
        self.words = pa.array([""], pa.string())
        self.ends, self.pool = np.zeros(2, np.int32), np.zeros(0, np.uint32)

    def _numbers(self, words: pa.Array) -> np.ndarray:
        if len(self.words) > KEPT_WORDS:
            self._forget()
        found = pc.index_in(words, value_set=self.words)
        new = words.filter(found.is_null())
        if len(new):
            made = [e.ids for e in self.tokenizer.encode_batch_fast(new.to_pylist(), add_special_tokens=False)]
            sizes = np.fromiter(map(len, made), np.int32, len(made))
            first = len(self.words)
            self.words = pa.concat_arrays([self.words, new])
            self.ends = np.append(self.ends, self.ends[-1] + np.cumsum(sizes, dtype=np.int32))
            ids = np.fromiter(itertools.chain.from_iterable(made), np.uint32, int(sizes.sum()))
            self.pool = np.concatenate((self.pool, ids))
        numbers = found.fill_null(-1).to_numpy().copy()
        if len(new):
            numbers[numbers < 0] = first + np.arange(len(new), dtype=np.int32)
        return numbers

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids one after the other, number of ids of each text)."""
        split = pc.ascii_split_whitespace(texts.cast(pa.string()).fill_null(""))
        lists = split.offsets.to_numpy()
        words = split.flatten().dictionary_encode()
        forms = words.dictionary
        forms = pc.if_else(pc.string_is_ascii(forms), pc.ascii_lower(forms), forms)
        ended = pc.match_substring_regex(forms, _TAIL)
        cut = forms.filter(ended)
        body, tail = (pc.replace_substring_regex(cut, _TAIL, part) for part in (r"\1", r"\2"))
        parts = pa.concat_arrays([forms.filter(pc.invert(ended)), body, tail]).dictionary_encode()
        number = self._numbers(parts.dictionary)[parts.indices.to_numpy()]
        # Each word is its body and its tail, which may be empty.
        pair = np.zeros((len(forms), 2), np.int32)
        ended = ended.to_numpy(zero_copy_only=False)
        uncut = len(forms) - len(cut)
        pair[~ended, 0] = number[:uncut]
        pair[ended, 0] = number[uncut : uncut + len(cut)]
        pair[ended, 1] = number[uncut + len(cut) :]
        number = pair[words.indices.to_numpy()].ravel()
        first = self.ends[number]
        length = self.ends[number + 1] - first
        ends = np.cumsum(length, dtype=np.int32)
        # Place of each id in the pool: its part's first place plus its number within the part.
        at = np.repeat(first - ends + length, length)
        at += np.arange(len(at), dtype=np.int32)
        return self.pool[at], np.diff(np.append(0, ends)[2 * (lists - lists[0])])


@functools.cache
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def piece_sizes(length: int, capacity: int = CAPACITY) -> list[int]:
    """Class sizes that add up to length, in falling order."""
    out = [capacity] * (length // capacity)
    left = length % capacity
    while left:
        size = capacity // -(-capacity // left)
        # capacity // j is the largest class size that fits for the smallest such j.
        out.append(size)
        left -= size
    return out


def cut_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents; those of full sequences with sequence_id and offset, held-back ones without.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, fold (pieces per sequence of this class),
    worker, sequence_id, offset.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(path)
        worker = TaskContext.get().partitionId()
        waiting: dict[int, list[tuple]] = {}
        filled = 0
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "fold", "worker", "sequence_id", "offset"]
        number = pa.int64()
        kinds = [kind, *[number] * 8]

        def rows(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [[]] * len(names)
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

        for whole in batches:
            for lo in range(0, len(whole), ROWS):
                batch = whole.slice(lo, ROWS)
                ids, counts = encode(batch.column(1))
                out, at = [], 0
                for doc_id, count in zip(batch.column(0).to_pylist(), counts.tolist()):
                    own = np.append(ids[at : at + count], np.uint32(end_id)).astype("<u4")
                    at += count
                    start = 0
                    for size in piece_sizes(len(own), capacity):
                        fold = capacity // size
                        crc = zlib.crc32(own[start : start + size])
                        bin_ = waiting.setdefault(fold, [])
                        bin_.append((doc_id, start, size, crc, len(own), fold, worker))
                        start += size
                        if len(bin_) == fold:
                            name = (worker << 32) | filled
                            filled += 1
                            out += [(*piece, name, i * size) for i, piece in enumerate(bin_)]
                            bin_.clear()
                yield rows(out)
        yield rows([(*piece, None, None) for bin_ in waiting.values() for piece in bin_])
        give_back()

    kind = pa.int64()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(
        made,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, fold long, worker long, "
        "sequence_id long, offset long",
    )


def _pack_rest(capacity: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Largest piece first into the first sequence with room; names count down from -1."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if not batches:
            return
        table = pa.Table.from_batches(batches).sort_by(
            [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("worker", "ascending")]
        )
        used: list[int] = []
        names, offsets = [], []
        for size in table["length"].to_pylist():
            i = next((i for i, u in enumerate(used) if u + size <= capacity), len(used))
            if i == len(used):
                used.append(0)
            names.append(-1 - i)
            offsets.append(used[i])
            used[i] += size
        table = table.append_column("sequence_id", pa.array(names, pa.int64()))
        yield from table.append_column("offset", pa.array(offsets, pa.int64())).to_batches()

    return packed


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Sequence names are worker << 32 | number for the workers' own, (1 << 62) + (class << 40) + number for
    those of held-back pieces, and negative for the last few.
    """
    with small_batches(docs.sparkSession, ROWS):
        pieces = stored(cut_pieces(docs, path, capacity, end_id), "pieces")
    done = pieces.filter(F.col("sequence_id").isNotNull())

    # Their running count numbers the pieces of a class. The window sees one number of a worker, not its pieces.
    held = (
        pieces.filter(F.col("sequence_id").isNull())
        .groupBy("fold", "worker")
        .agg(F.sort_array(F.collect_list(F.struct("doc_id", "start", "length", "ids_crc32", "doc_tokens"))).alias("held"))
    )
    held = stored(held.withColumn("n_held", F.size("held")), "held-back")
    of_class = Window.partitionBy("fold")
    before = F.sum("n_held").over(of_class.orderBy("worker")) - F.col("n_held")
    counts = held.select("fold", "worker", "n_held").select(
        "fold", "worker", before.alias("before"), F.sum("n_held").over(of_class).alias("total")
    )
    numbered = (
        held.select("fold", "worker", F.posexplode("held"))
        .join(counts, ["fold", "worker"])
        .select("fold", "worker", "total", (F.col("before") + F.col("pos")).alias("n"), "col.*")
    )
    numbered = stored(numbered.withColumn("bin", F.expr("n div fold")), "held")
    full = (F.col("bin") + 1) * F.col("fold") <= F.col("total")
    name = F.lit(1 << 62) + F.shiftleft("fold", 40) + F.col("bin")
    filled = numbered.filter(full).withColumns(
        {"sequence_id": name, "offset": (F.col("n") % F.col("fold")) * F.col("length")}
    )
    # Fewer than fold pieces of each class are left, a number that depends on the capacity alone.
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    rest = (
        numbered.filter(~full)
        .select(*columns, "worker")
        .coalesce(1)
        .mapInArrow(
            _pack_rest(capacity),
            ", ".join([*(f"{c} long" for c in columns), "worker long", "sequence_id long", "offset long"]),
        )
    )
    columns += ["sequence_id", "offset"]
    return done.select(columns).unionByName(filled.select(columns)).unionByName(rest.select(columns))
