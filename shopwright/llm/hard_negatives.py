"""Hard negatives: for an anchor and each of its positives, the nearest rows of other labels
whose score lies in a window below the positive's score.

Rows are packed into blocks, and so are the anchors, a stated part of the rows. Every
block of anchors meets every block of rows as one matrix product. A block gives on only what
can still count: the best few positives of an anchor, and then, with the anchor's windows known, the best
few rows inside each window. Both go through a secondary sort: rows are dealt by anchor,
sorted by (anchor, falling score, id) within partitions, and read once by an iterator that opens a
window at each positive and emits the negatives that follow. It holds at most
``positives`` windows, whatever the number of rows of an anchor; the blocks bound what an anchor sends.

Scores are inner products of integers, floor(scale * x) of each component. They are exact: in
floating point where no sum can reach 2^53, in Python's integers otherwise; a score beyond a long is an error.

Defined cases: a row takes no part if its id, label or vector is null or a component is null or not
finite. Vectors of different lengths never meet; two empty ones score 0. Higher scores come first, ties by
smaller id. "Other rows" are those with another id. A row that is there several times is as many
positives or negatives, but one anchor; anchors that share an id and differ otherwise are anchors of their own.
An anchor without positives, or a positive with a negative score, gives nothing. An empty table gives no rows.
Columns other than id, label and vector are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopwright.shared import stored

BLOCK_BYTES = 1 << 20
ANCHOR_BYTES = 1 << 18
ANCHORS_A_TASK = 8192
_EXACT = 2**53
_LONG = 2**63


def _matrix(column: pa.Array, rows: np.ndarray, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """The chosen lists as a matrix of whole numbers, and which of them are finite without nulls."""
    chosen = column.take(pa.array(rows)).flatten().cast(pa.float64())
    values = np.asarray(chosen.to_numpy(zero_copy_only=False), np.float64).reshape(len(rows), dims)
    with np.errstate(over="ignore", invalid="ignore"):
        values = np.floor(values * scale)
    return values, np.isfinite(values).all(axis=1)


def _blocks(rows: DataFrame, scale: int, most_bytes: int, keyed: bool) -> DataFrame:
    """Rows packed by equal length of the vector: dims, n, ids, labels, vectors, and for anchors marks and windows."""
    columns = ["vec_id", "label", "vector"] + (["mark", "scores"] if keyed else [])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, label, vector = (batch.column(i) for i in range(3))
            ids, label = ids.to_numpy(zero_copy_only=False), label.to_numpy(zero_copy_only=False)
            length = vector.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            for dims in np.unique(length):
                at = np.flatnonzero(length == dims)
                # By id, so that a block's earlier row wins a tie.
                at = at[np.argsort(ids[at], kind="stable")]
                step = max(1, most_bytes // (8 * max(1, int(dims))))
                for lo in range(0, len(at), step):
                    part = at[lo : lo + step]
                    values, good = _matrix(vector, part, int(dims), scale)
                    if not good.any():
                        continue
                    part, values = part[good], np.ascontiguousarray(values[good])
                    row = {
                        "dims": [int(dims)],
                        "n": [len(part)],
                        "ids": [ids[part].astype(np.int64).tobytes()],
                        "labels": [label[part].astype(np.int64).tobytes()],
                        "vectors": [values.tobytes()],
                    }
                    if keyed:
                        row["marks"] = [batch.column(3).to_numpy(zero_copy_only=False)[part].astype(np.int64).tobytes()]
                        row["windows"] = [[batch.column(4)[int(i)].as_py() or [] for i in part]]
                    yield pa.RecordBatch.from_pydict(row, schema=_schema(keyed))

    kind = "dims long, n long, ids binary, labels binary, vectors binary"
    if keyed:
        kind += ", marks binary, windows array<array<long>>"
    return rows.select(*columns).mapInArrow(made, kind)


def _schema(keyed: bool) -> pa.Schema:
    fields = [("dims", pa.int64()), ("n", pa.int64()), ("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary())]
    if keyed:
        fields += [("marks", pa.binary()), ("windows", pa.list_(pa.list_(pa.int64())))]
    return pa.schema(fields)


def _scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """All inner products of rows, exactly, as longs."""
    reach = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * left.shape[1]
    if reach < _EXACT:
        return (left @ right.T).astype(np.int64)
    exact = _exact_ints(left).dot(_exact_ints(right).T)
    if not (-_LONG < exact.min() and exact.max() < _LONG):
        raise ValueError("a score does not fit into a long")
    return exact.astype(np.int64)


def _exact_ints(values: np.ndarray) -> np.ndarray:
    """Whole floats beyond 2^53 as Python integers."""
    return np.vectorize(int, otypes=[object])(values)


def _best(scores: np.ndarray, wanted: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of each row's k greatest wanted scores, ties to the earlier column."""
    if wanted.shape[1] > k:
        # The k-th greatest wanted score of a row bounds what can be among its first k.
        floor = np.iinfo(np.int64).min
        masked = np.where(wanted, scores, floor)
        least = np.partition(masked, -k, axis=1)[:, -k]
        wanted = wanted & (scores >= least[:, None])
    row, column = np.nonzero(wanted)
    order = np.lexsort((column, -scores[row, column], row))
    row, column = row[order], column[order]
    first = np.searchsorted(row, row)
    keep = np.arange(len(row)) - first < k
    return row[keep], column[keep]


def _candidates(
    blocks: DataFrame, anchors: DataFrame, positives: int, negatives: int, low: int, high: int, kind: int
) -> DataFrame:
    """(anchor_id, mark, kind, score, vec_id) of what a block can add: positives (kind 0) or negatives (kind 1)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                cell = {name: batch.column(name)[i] for name in batch.schema.names}
                dims = cell["dims"].as_py()
                if dims != cell["a_dims"].as_py():
                    continue
                ids, labels = (np.frombuffer(cell[c].as_buffer(), np.int64) for c in ("ids", "labels"))
                a_ids, a_labels, marks = (
                    np.frombuffer(cell[c].as_buffer(), np.int64) for c in ("a_ids", "a_labels", "a_marks")
                )
                vectors = np.frombuffer(cell["vectors"].as_buffer(), np.float64).reshape(len(ids), dims)
                mine = np.frombuffer(cell["a_vectors"].as_buffer(), np.float64).reshape(len(a_ids), dims)
                scores = _scores(mine, vectors)
                same = a_labels[:, None] == labels[None, :]
                if kind == 0:
                    row, column = _best(scores, same & (a_ids[:, None] != ids[None, :]), positives)
                else:
                    windows = cell["a_windows"].as_py()
                    lows = np.full((len(a_ids), positives), np.iinfo(np.int64).max)
                    highs = np.full((len(a_ids), positives), np.iinfo(np.int64).min)
                    for j, scored in enumerate(windows):
                        for w, score in enumerate(scored):
                            lows[j, w], highs[j, w] = -(-low * score // 100), high * score // 100
                    codes = []
                    for w in range(positives):
                        inside = ~same & (scores >= lows[:, w : w + 1]) & (scores <= highs[:, w : w + 1])
                        if inside.any():
                            r, c = _best(scores, inside, negatives)
                            codes.append(r * len(ids) + c)
                    if not codes:
                        continue
                    row, column = np.divmod(np.unique(np.concatenate(codes)), len(ids))
                if not len(row):
                    continue
                yield pa.record_batch(
                    [
                        pa.array(a_ids[row]),
                        pa.array(marks[row]),
                        pa.array(np.full(len(row), kind, np.int32)),
                        pa.array(scores[row, column]),
                        pa.array(ids[column]),
                    ],
                    names=["anchor_id", "mark", "kind", "score", "vec_id"],
                )

    paired = blocks.select("dims", "ids", "labels", "vectors").crossJoin(
        anchors.select(
            *(F.col(c).alias(f"a_{c}") for c in ("dims", "ids", "labels", "vectors", "marks", "windows"))
        )
    )
    return paired.mapInArrow(made, "anchor_id long, mark long, kind int, score long, vec_id long")


def _sorted(candidates: DataFrame) -> DataFrame:
    """Each anchor's rows in one partition, by falling score; at a tie positives first, then by id."""
    return candidates.repartition("anchor_id", "mark").sortWithinPartitions(
        "anchor_id", "mark", F.col("score").desc(), "kind", "vec_id"
    )


def _first_positives(candidates: DataFrame, positives: int) -> DataFrame:
    """The first rows of each anchor: anchor_id, mark, kind, score, vec_id."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, taken = None, 0
        for batch in batches:
            keep = []
            for key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != anchor:
                    anchor, taken = key, 0
                taken += 1
                keep.append(taken <= positives)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return _sorted(candidates).mapInArrow(made, candidates.schema)


def _emitted(candidates: DataFrame, negatives: int, low: int, high: int) -> DataFrame:
    """One pass over the sorted rows: a positive opens a window, a negative goes to every open window it lies in."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, windows = None, []
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [])
            for anchor_id, mark, kind, score, vec_id in zip(*(c.to_pylist() for c in batch.columns)):
                if (anchor_id, mark) != anchor:
                    anchor, windows = (anchor_id, mark), []
                if kind == 0:
                    windows.append([vec_id, score, 0])
                    continue
                for window in windows:
                    positive, near, given = window
                    if given < negatives and low * near <= 100 * score <= high * near:
                        window[2] = given + 1
                        for column, value in zip(out, (anchor_id, positive, given + 1, vec_id, near, score)):
                            column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds)], names=_RESULT)

    return _sorted(candidates).mapInArrow(
        made, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    )


_RESULT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` has vec_id, label and vector; ``is_anchor`` is a condition on them. A negative's score lies
    between ``low`` and ``high`` percent of the positive's.
    """
    taking = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("vector").cast("array<double>").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    ).filter("vec_id is not null and label is not null and vector is not null")
    blocks = stored(_blocks(taking, scale, BLOCK_BYTES, keyed=False), "vector-blocks")
    chosen = (
        taking.filter("is_anchor")
        .withColumn("mark", F.xxhash64("label", "vector"))
        .dropDuplicates(["vec_id", "mark"])
        .select("vec_id", "label", "vector", "mark")
    )
    chosen = stored(chosen, "anchors")
    # Small files would make as many small products.
    chosen = chosen.repartition(max(1, chosen.count() // ANCHORS_A_TASK))
    unscored = _blocks(chosen.withColumn("scores", F.lit(None).cast("array<long>")), scale, ANCHOR_BYTES, keyed=True)
    found = _candidates(blocks, stored(unscored, "anchor-blocks"), positives, negatives, low, high, 0)
    firsts = stored(_first_positives(found, positives), "positives")
    scores = firsts.groupBy("anchor_id", "mark").agg(F.collect_set("score").alias("scores"))
    scored = chosen.join(scores.withColumnRenamed("anchor_id", "vec_id"), ["vec_id", "mark"])
    windowed = stored(_blocks(scored, scale, ANCHOR_BYTES, keyed=True), "anchor-blocks")
    below = _candidates(blocks, windowed, positives, negatives, low, high, 1)
    return _emitted(firsts.unionByName(below), negatives, low, high)


def mined(embeddings: DataFrame) -> DataFrame:
    """The query: anchors are ids divisible by 100; ids divisible by 7 move to the next of ten labels."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings.select("vec_id", label.alias("label"), F.col("embedding").alias("vector"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)
