"""Collocations: phrases whose words stand together far more often than their parts' counts let expect.

Texts are parsed into overlapping chunks. A chunk starts at the beginning of a text, where the hash of
two neighbouring words is divisible by ``TRIGGER``, and ``MAX_CHUNK`` words after the last start; it
runs to the next start and then as far into its last piece as a phrase can reach. As starts follow from content, copies
and shared passages give the same chunks. Distinct chunks form the dictionary, each with its frequency.
A phrase's count is the sum of frequencies over its places in distinct chunks; a place belongs to the
chunk in which its first word comes before the next start, so overlaps count once.

Counting prunes by what a frequent phrase needs: frequent words, pairs and triples. Each are found
as sums by hash, in about as many places as there are words, which can only be too high. A task sends its sums as packed
ranges of places, and a range is summed by one task in an array of fixed size. The places that
reach the limit are handed on as one bit table of ``BITS`` bits, whatever the size of the corpus; a bit set by
another hash only lets more pass. Phrases that pass are then counted as strings, so counts are exact.

Defined cases: a null text is empty, a null language is "und". Languages are apart. Repeated rows
count repeatedly. Of equally low cuts the one after fewest words counts. Columns other than text and lang are
ignored. An empty table gives no rows. A word or text of any length is taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopwright.llm import grams
from shopwright.shared import stored

TRIGGER = 64
MAX_CHUNK = 1024
BITS = 1 << 26
LEVELS = 3
RANGE_BITS = 20
HELD = 2_000_000
UNKNOWN = "und"
# What ends a piece, and what separates words.
PIECE_END = np.isin(np.arange(256), [*b".,;:!?", 10, 11, 12, 13])
WORD = ~(PIECE_END | np.isin(np.arange(256), [9, 32]))
_SALT = np.uint64(0x8CB92BA72F3D8DD7)


def _runs(values: np.ndarray) -> np.ndarray:
    """Number of the run of equal neighbouring values that each value is in."""
    return np.append(0, np.cumsum(values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)


def _pieces(words: grams.Words, text: np.ndarray) -> np.ndarray:
    """Number of each word's piece; pieces end at texts' ends too."""
    ended = np.cumsum(PIECE_END[words.data])[words.start] if len(words.start) else np.zeros(0, np.int64)
    return _runs(ended + text.astype(np.int64) * (len(words.data) + 1))


def _gathered(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The strings data[start[i]:end[i]]."""
    offsets = np.append(0, np.cumsum(end - start))
    at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], end - start)
    if offsets[-1] < 2**31:
        return pa.Array.from_buffers(
            pa.string(), len(start), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data[at]))]
        )
    return pa.array([data[a:b].tobytes().decode() for a, b in zip(start, end)], pa.string())


def _starts(words: grams.Words, text: np.ndarray, trigger: int, longest: int) -> np.ndarray:
    """Places of the words that begin a chunk."""
    other = text[1:] != text[:-1]
    begins = np.append(True, other)
    begins[:-1] |= ~other & (grams.grams(words.hashes, 2) % np.uint64(trigger) == 0)
    start = np.flatnonzero(begins)
    gap = np.diff(np.append(start, len(text)))
    extra = (gap - 1) // longest
    if extra.any():
        more = np.repeat(start, extra)
        step = np.arange(len(more)) - np.repeat(np.cumsum(extra) - extra, extra) + 1
        start = np.sort(np.append(start, more + step * longest))
    return start


def dictionary(docs: DataFrame, max_words: int, trigger: int, longest: int) -> DataFrame:
    """lang, chunk, own (how many of its words count in it), times."""

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in grams.slices(batch.column(1)):
                words = grams.words(data, offsets, WORD)
                if not len(words.start):
                    continue
                text = np.repeat(np.arange(hi - lo), np.diff(words.first))
                piece = _pieces(words, text)
                start = _starts(words, text, trigger, longest)
                stop = np.append(start[1:], len(text))
                # Into the piece of its last own word, as far as a phrase can reach.
                piece_end = np.searchsorted(piece, piece[stop - 1], "right")
                reach = np.minimum(stop + max_words - 1, piece_end)
                yield pa.record_batch(
                    [
                        batch.column(0).take(pa.array(lo + text[start])),
                        _gathered(words.data, words.start[start], words.end[reach - 1]),
                        pa.array((stop - start).astype(np.int32)),
                    ],
                    names=["lang", "chunk", "own"],
                )
        grams.give_back()

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), "text").filter("text is not null")
    return (
        rows.mapInArrow(parsed, "lang string, chunk string, own int")
        .groupBy("lang", "chunk", "own")
        .agg(F.count("*").alias("times"))
    )


class _Chunks:
    """Words of some chunks with everything that counting needs."""

    def __init__(self, batch: pa.RecordBatch, lo: int, hi: int, data: np.ndarray, offsets: np.ndarray) -> None:
        self.words = words = grams.words(data, offsets, WORD)
        count = np.diff(words.first)
        self.row = row = np.repeat(np.arange(lo, hi), count)
        inside = np.arange(len(row)) - np.repeat(words.first[:-1], count)
        self.own = inside < batch.column(2).to_numpy()[row]
        self.times = batch.column(3).to_numpy()[row]
        self.piece = _pieces(words, row - lo)
        lang = batch.column(0).dictionary_encode()
        salts = np.array([_lang_salt(v) for v in lang.dictionary.to_pylist()], np.uint64)
        self.salt = salts[lang.indices.to_numpy()[row]] if len(row) else np.zeros(0, np.uint64)

    def keys(self, n: int) -> np.ndarray:
        """Hash of the n words from each place on, with the language; ends of pieces ignored."""
        whole = self.words.hashes if n == 1 else grams.grams(self.words.hashes, n)
        return grams.mixed(whole + self.salt[: len(whole)])

    def whole(self, n: int) -> np.ndarray:
        """Whether n words of one piece begin at a place."""
        size = max(0, len(self.piece) - n + 1)
        return self.piece[:size] == self.piece[n - 1 : n - 1 + size]


def _lang_salt(lang: str) -> np.uint64:
    value = 0xCBF29CE484222325
    for byte in lang.encode():
        value = (value ^ byte) * 0x100000001B3 % 2**64
    return np.uint64(value) ^ _SALT


def _chunks(batch: pa.RecordBatch) -> Iterator[_Chunks]:
    for piece in grams.slices(batch.column(1)):
        yield _Chunks(batch, *piece)


def _marked(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    place = (keys & np.uint64(8 * len(bits) - 1)).astype(np.int64)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _possible(chunks: _Chunks, tables: list[np.ndarray]) -> list[np.ndarray]:
    """For n = 1, 2, ... where n words begin of which all shorter stretches are frequent: the last list
    by what precedes alone, the others by their own bit table too."""
    out = [np.ones(len(chunks.piece), bool)]
    for n, bits in enumerate(tables, 1):
        ok = out[-1] & _marked(chunks.keys(n), bits)[: len(out[-1])]
        out[-1] = ok
        out.append(chunks.whole(n + 1) & ok[:-1] & ok[1:] if len(ok) > 1 else np.zeros(0, bool))
    return out


def _packed(place: np.ndarray, times: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Sums by place as (range of places, bytes): rising places by their differences, in planes of bytes."""
    if not len(place):
        return
    order = np.argsort(place, kind="stable")
    place = place[order]
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    total, place = np.add.reduceat(times[order], first), place[first]
    packer = zstandard.ZstdCompressor(level=1)
    ends = np.flatnonzero(np.append((place[1:] >> RANGE_BITS) != (place[:-1] >> RANGE_BITS), True)) + 1
    for lo, hi in zip(np.append(0, ends[:-1]), ends):
        inside = place[lo:hi] & ((1 << RANGE_BITS) - 1)
        steps = np.diff(inside, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T
        counts = total[lo:hi].astype("<i8").view(np.uint8).reshape(-1, 8).T
        yield int(place[lo] >> RANGE_BITS), packer.compress(np.concatenate((steps.ravel(), counts.ravel())).tobytes())


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(12, -1)
    steps = np.ascontiguousarray(planes[:4].T).view("<u4").ravel()
    return np.cumsum(steps.astype(np.int64)), np.ascontiguousarray(planes[4:].T).view("<i8").ravel()


def _frequent(chunked: DataFrame, n: int, least: int, places: int, tables: list[Broadcast]) -> DataFrame:
    """h: places of a table of ``places`` sums, by hashes of n words, that reach ``least``.

    A frequent phrase's place does so; with about two phrases a place, few others do.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [t.value for t in tables]
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def given() -> pa.RecordBatch:
            rows = list(_packed(*(np.concatenate(c) for c in zip(*held)))) if held else []
            held.clear()
            return pa.record_batch(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["part", "sums"]
            )

        for batch in batches:
            for chunks in _chunks(batch):
                ok = _possible(chunks, known)[n - 1]
                ok = ok & chunks.own[: len(ok)]
                place = (chunks.keys(n)[: len(ok)][ok] & np.uint64(places - 1)).astype(np.int64)
                held.append((place, chunks.times[: len(ok)][ok]))
                if sum(len(p) for p, _ in held) >= HELD:
                    yield given()
        if held:
            yield given()
        grams.give_back()

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sums = None, np.zeros(1 << RANGE_BITS, np.int64)

        def reached() -> pa.RecordBatch:
            return pa.record_batch([pa.array(np.flatnonzero(sums >= least) + (part << RANGE_BITS))], names=["h"])

        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if number != part:
                    if part is not None:
                        yield reached()
                    part = number
                    sums[:] = 0
                at, times = _unpacked(data)
                sums[at] += times
        if part is not None:
            yield reached()

    parts = chunked.mapInArrow(counted, "part long, sums binary").repartition("part").sortWithinPartitions("part")
    return parts.mapInArrow(summed, "h long")


def _bit_table(hashes: DataFrame, places: int) -> Broadcast:
    """BITS bits at most, those of the places set; they come to the driver in pieces of 4 KiB."""
    size = min(places, BITS)
    place = F.col("h").bitwiseAND(F.lit(size - 1))
    rows = (
        hashes.groupBy(F.shiftright(place, 15).alias("part"))
        .agg(F.bitmap_construct_agg(place.bitwiseAND(F.lit(32767))).alias("bits"))
        .collect()
    )
    bits = np.zeros(size // 8, np.uint8)
    for row in rows:
        bits[row["part"] * 4096 : (row["part"] + 1) * 4096] = np.frombuffer(row["bits"], np.uint8)
    return hashes.sparkSession.sparkContext.broadcast(bits)


def _phrase_counts(chunked: DataFrame, max_words: int, least: int, tables: list[Broadcast]) -> DataFrame:
    """lang, k (its words), phrase, f for all phrases with f >= least."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [t.value for t in tables]
        for batch in batches:
            for chunks in _chunks(batch):
                words = chunks.words
                if not len(words.start):
                    continue
                # The words with one space after each; a phrase is a stretch of it.
                length = words.end - words.start
                at = np.append(0, np.cumsum(length + 1))
                joined = np.full(at[-1], 32, np.uint8)
                place = np.arange(at[-1] - len(length)) + np.repeat(np.arange(len(length)), length)
                joined[place] = words.data[
                    np.arange(len(place)) + np.repeat(words.start - (at[:-1] - np.arange(len(length))), length)
                ]
                possible = _possible(chunks, known)[: len(known)]
                for k in range(1, max_words + 1):
                    if k <= len(known):
                        ok = possible[k - 1]
                    else:
                        # All stretches as long as the last table's phrases are frequent.
                        ok = ok[:-1] & possible[-1][k - len(known) :] if len(ok) else ok
                    begin = np.flatnonzero(ok & chunks.own[: len(ok)])
                    if not len(begin):
                        continue
                    table = pa.table(
                        {
                            "lang": batch.column(0).take(pa.array(chunks.row[begin])),
                            "phrase": _gathered(joined, at[begin], at[begin + k] - 1),
                            "c": chunks.times[begin],
                        }
                    )
                    summed = table.group_by(["lang", "phrase"], use_threads=False).aggregate([("c", "sum")])
                    summed = summed.select(["lang", "phrase", "c_sum"]).append_column("k", pa.array(np.full(len(summed), k, np.int32)))
                    yield from summed.rename_columns(["lang", "phrase", "c", "k"]).to_batches()
        grams.give_back()

    return (
        chunked.mapInArrow(counted, "lang string, phrase string, c long, k int")
        .groupBy("lang", "k", "phrase")
        .agg(F.sum("c").alias("f"))
        .filter(F.col("f") >= least)
    )


def phrase_counts(docs: DataFrame, max_words: int = 5, least: int = 100) -> tuple[DataFrame, DataFrame]:
    """(lang, k, phrase, f) of phrases of up to max_words words, and (lang, n) of all words."""
    chunked = stored(dictionary(docs, max_words, TRIGGER, MAX_CHUNK), "chunks", "zstd")
    totals = chunked.groupBy("lang").agg(F.sum(F.col("own") * F.col("times")).alias("n"))
    places = 1 << RANGE_BITS
    while 2 * places < (totals.agg(F.sum("n").alias("n")).first()["n"] or 0):
        places *= 2
    tables: list[Broadcast] = []
    for n in range(1, min(LEVELS, max_words) + 1):
        tables.append(_bit_table(_frequent(chunked, n, least, places, tables), places))
    return stored(_phrase_counts(chunked, max_words, least, tables), "phrases"), totals


def _words(first: F.Column, last: F.Column) -> F.Column:
    return F.array_join(F.slice("words", first, last - first + 1), " ")


def collocations(docs: DataFrame, max_words: int = 5, least: int = 100, top: int = 2000) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score.

    a is the phrase's count, n that of all words, l and r the counts of both sides of the cut
    with the lowest floor(1000 * a * n / (l * r)). A phrase inside a longer one that is as frequent is left out.
    """
    counts, totals = phrase_counts(docs, max_words, least)
    phrases = counts.filter("k > 1").withColumn("words", F.split("phrase", " "))
    # What is as frequent inside a longer phrase is so inside one that is one word longer.
    covered = phrases.filter("k > 2").select(
        "lang", "f", F.explode(F.array(_words(F.lit(1), F.col("k") - 1), _words(F.lit(2), F.col("k")))).alias("phrase")
    )
    phrases = phrases.join(covered, ["lang", "phrase", "f"], "left_anti")
    cuts = phrases.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))).select(
        "lang", "phrase", F.col("f").alias("a"), "cut",
        _words(F.lit(1), F.col("cut")).alias("left"), _words(F.col("cut") + 1, F.col("k")).alias("right"),
    )
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    cuts = cuts.join(totals, "lang")

    def exact(name: str) -> F.Column:
        return F.col(name).cast("decimal(19,0)")

    cuts = cuts.withColumn("over", (exact("a") * exact("n")).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)"))
    cuts = cuts.withColumn("under", exact("l") * exact("r")).withColumn("score", F.expr("over div under"))
    lowest = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))
    order = Window.partitionBy("lang").orderBy(F.col("low.score").desc(), F.col("a").desc(), "phrase")
    ranked = lowest.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("low.l").alias("l"),
        F.col("low.r").alias("r"), "n", F.col("low.score").alias("score"),
    )
