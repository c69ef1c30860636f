"""Benchmark decontamination: word windows of test items found in documents.

Items are cut into windows of ``n`` words, an item with fewer words being one window.
Their hashes form a sorted set that is broadcast; documents are scanned in Arrow
batches, the rolling hash of every window of theirs is looked up, and hits are
confirmed word by word against the items' windows.

A set holds about ``SET_WINDOWS`` pairs of a window and an item at most, counted before. More are
dealt to several sets by a hash of both; each set is a scan over the rows of the one before and
adds to their hits, so the result is the same for any number of sets.

Defined cases: null and empty texts have no words, so an empty item is never found.
Repeated documents are each reported; items with equal windows are all named, and
an item listed twice counts once. Items with a null id are one, called null in the digest, and not
the one whose id is "null". Extra columns of documents stay (``clean``, ``hits``), whatever their names, or are
ignored (``contamination``). Without items nothing is hit.
"""

from __future__ import annotations

import functools
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopwright.llm import grams
from shopwright.llm.expr import unused
from shopwright.shared import stored

WINDOW = 10
SET_WINDOWS = 500_000

# The words of the rule, over bytes in either case.
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_WORDS, _SPANS, _ITEMS = "_hit_words", "_hit_spans", "_hit_items"
_SPAN_LIST = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def item_windows(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """item_id (string), window (its words with single spaces), words (their number); distinct."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, windows, sizes = [], [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = np.frombuffer((text or "").encode(), np.uint8)
                words = _WORD.findall(grams.LOWER[data].tobytes())
                size = min(n, len(words))
                found = {b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)} if size else ()
                ids += [item] * len(found)
                windows += found
                sizes += [size] * len(found)
            yield pa.record_batch(
                [pa.array(ids, pa.string()), pa.array(windows, pa.binary()), pa.array(sizes, pa.int32())],
                names=["item_id", "window", "words"],
            )

    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    return items.mapInArrow(cut, "item_id string, window binary, words int").distinct()


class WindowSet:
    """Windows by their text, and their hashes by length as sorted arrays."""

    def __init__(self, rows: list[tuple[str, bytes, int]]) -> None:
        self.items: dict[bytes, list[str]] = defaultdict(list)
        by_size: dict[int, set[bytes]] = defaultdict(set)
        for item, window, size in rows:
            self.items[bytes(window)].append(item)
            by_size[size].add(bytes(window))
        self.hashes = {}
        for size, windows in by_size.items():
            data = np.frombuffer(b" ".join(sorted(windows)), np.uint8)
            words = grams.words(data, np.array([0, len(data)]), grams.ALNUM_WORD)
            self.hashes[size] = np.unique(grams.grams(words.hashes, size)[::size])

    @functools.cached_property
    def marks(self) -> dict[int, np.ndarray]:
        """A bitmap of the hashes' low bits, so that most look-ups end early."""
        out = {}
        for size, hashes in self.hashes.items():
            bits = max(16, int(len(hashes)).bit_length() + 5)
            out[size] = np.zeros(1 << bits, bool)
            out[size][(hashes & np.uint64((1 << bits) - 1)).astype(np.int64)] = True
        return out

    def found(self, words: grams.Words) -> Iterator[tuple[int, int, list[str]]]:
        """(first word, last word + 1, items) of each confirmed window inside one text."""
        for size, hashes in self.hashes.items():
            rolling = grams.grams(words.hashes, size)
            mark = self.marks[size]
            at = np.flatnonzero(mark[(rolling & np.uint64(len(mark) - 1)).astype(np.int64)])
            known = np.minimum(np.searchsorted(hashes, rolling[at]), len(hashes) - 1)
            at = at[hashes[known] == rolling[at]]
            text = np.searchsorted(words.first, at, "right") - 1
            for i in at[at + size <= words.first[text + 1]].tolist():
                items = self.items.get(words.string(i, i + size))
                if items:
                    yield i, i + size, items


def _merged(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    out: list[dict[str, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1]["end"]:
            out[-1]["end"] = max(hi, out[-1]["end"])
        else:
            out.append({"start": lo, "end": hi})
    return out


def _scan(docs: DataFrame, windows: Broadcast, own: tuple[str, str, str], again: bool) -> DataFrame:
    """docs with its hits in the columns ``own``; hits of an earlier scan are added to."""
    place, names = docs.columns.index("text"), docs.columns
    n_words, hit_spans, hit_items = own
    kept = [i for i, name in enumerate(names) if not again or name not in own]

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = windows.value
        for batch in batches:
            for lo, hi, data, offsets in grams.slices(batch.column(place)):
                part = batch.slice(lo, hi - lo)
                words = grams.words(data, offsets, grams.ALNUM_WORD)
                spans, items = defaultdict(list), defaultdict(set)
                if again:
                    old, by = (part.column(names.index(c)).to_pylist() for c in (hit_spans, hit_items))
                    for i in range(hi - lo):
                        spans[i] += [(s["start"], s["end"]) for s in old[i]]
                        items[i].update(by[i])
                for start, end, named in known.found(words):
                    text = int(np.searchsorted(words.first, start, "right")) - 1
                    base = int(words.first[text])
                    spans[text].append((start - base, end - base))
                    items[text].update(named)
                rows = range(hi - lo)
                in_order = [sorted(items.get(i, ()), key=lambda v: (v is not None, v or "")) for i in rows]
                yield pa.record_batch(
                    [
                        *(part.column(i) for i in kept),
                        pa.array(np.diff(words.first), pa.int64()),
                        pa.array([_merged(spans.get(i, [])) for i in rows], _SPAN_LIST),
                        pa.array(in_order, pa.list_(pa.string())),
                    ],
                    names=[*(names[i] for i in kept), *own],
                )

    columns = [f"`{names[i]}` {docs.schema[i].dataType.simpleString()}" for i in kept]
    made = f"`{n_words}` long, `{hit_spans}` array<struct<start:long,end:long>>, `{hit_items}` array<string>"
    return docs.mapInArrow(scanned, ", ".join([*columns, made]))


def own_names(docs: DataFrame) -> tuple[str, str, str]:
    """Names of the columns that ``hits`` adds: _hit_words, _hit_spans and _hit_items, or longer ones if docs has these."""
    return tuple(unused(name, docs.columns) for name in (_WORDS, _SPANS, _ITEMS))


def hits(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, set_windows: int = SET_WINDOWS) -> DataFrame:
    """docs with three columns more (see ``own_names``): its number of words, the word ranges covered by
    windows, disjoint and in order, and the items found, sorted (a null id first)."""
    windows = stored(item_windows(benchmark, n), "item-windows")
    sets = max(1, -(-windows.count() // set_windows))
    # Dealt by window and item, so that a window of very many items is in many sets, of about set_windows rows each.
    dealt = windows.withColumn("set", F.pmod(F.xxhash64("window", "item_id"), F.lit(sets)))
    own = own_names(docs)
    for i in range(sets):
        rows = dealt.filter(F.col("set") == i).select("item_id", "window", "words").collect()
        docs = _scan(docs, docs.sparkSession.sparkContext.broadcast(WindowSet([tuple(r) for r in rows])), own, i > 0)
    return docs


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, set_windows: int = SET_WINDOWS) -> DataFrame:
    """Per document: how many of its words are hit and by which items."""
    found = hits(docs.select("doc_id", "text"), benchmark, n, set_windows)
    n_hit = F.aggregate(_SPANS, F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    named = F.array_sort(F.transform(_ITEMS, lambda item: F.coalesce(item, F.lit("null"))))
    return found.select(
        "doc_id",
        F.col(_WORDS).alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(_ITEMS).cast("long").alias("n_items"),
        F.sha2(F.array_join(named, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def _cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
    """Each text without its spans, from the first word's first letter to the last word's last."""
    out = []
    for text, ranges in zip(texts, spans):
        if text is None or not len(ranges):
            out.append(text)
            continue
        data = text.encode()
        places = [m.span() for m in _WORD.finditer(data)]
        kept, at = [], 0
        for r in ranges:
            kept.append(data[at : places[r["start"]][0]])
            at = places[r["end"] - 1][1]
        out.append(b"".join([*kept, data[at:]]).decode())
    return pd.Series(out, dtype=object)


def clean(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, remove: str = "documents") -> DataFrame:
    """The documents without test passages, in the columns they came with.

    remove="documents" drops every document with a hit; remove="spans" takes the
    hit words out of its text, with what stands between them, and keeps the rest.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be documents or spans, not {remove!r}")
    found, (_, spans, _) = hits(docs, benchmark, n), own_names(docs)
    if remove == "documents":
        found = found.filter(F.size(spans) == 0)
    else:
        found = found.withColumn("text", F.pandas_udf(_cut, "string")("text", spans))
    return found.select(*(f"`{c}`" for c in docs.columns))
