"""Ordered work inside groups when one group may hold a large share of all rows.

A window partitioned by a key sends each key to one task. That is what we want
for ordinary keys and what we cannot afford for a key with a third of the table.
Here such heavy groups are cut into chunks that follow the sort order, windows
run inside the chunks, and one small row per chunk carries counts, sums and edge
rows over the cuts. The answer is the same whether or not a group was cut, so an
approximate search for heavy groups is enough.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopwright.shared import checkpointed, shared_folder

# Groups beyond this many rows are cut; below it one task sorts a group with ease.
# A session may set another bound under this name.
GROUP_ROWS_CONF = "spark.shopwright.groupRows"
GROUP_ROWS = 2_000_000

# Rows per chunk of a cut group, where the session's shuffle partitions would be larger.
CHUNK_ROWS = GROUP_ROWS

# Heavy groups are looked for with frequent-items sketches, one per slice of the
# key space, so that no single task merges the sketches of all others. In a slice
# any group beyond about 0.35 % of its rows is found. Each task of the scan sends
# SLICES * SKETCH_ITEMS counters at most, and the driver gets at most
# SLICES * PER_SLICE numbers.
SLICES = 64
PER_SLICE = 32
SKETCH_ITEMS = 1_000

_TIE, _CHUNK, _POS = "__tie", "__chunk", "__pos"


class _Probe:
    def __repr__(self) -> str:
        return "PROBE"


# Default for ``heavy``: look at the data first.
PROBE = _Probe()

Heavy = Column | None | _Probe


def heavy_groups(df: DataFrame, keys: Sequence[str]) -> Column | None:
    """Predicate for rows in groups too large for one task; None if there are none.

    One aggregation over the key columns alone.
    """
    # Cutting needs the shared folder. Asking for it here makes its absence an error at any size.
    shared_folder(df.sparkSession)
    bound = int(df.sparkSession.conf.get(GROUP_ROWS_CONF, str(GROUP_ROWS)))
    digest = F.xxhash64(*keys)
    found = (
        df.select(digest.alias("h"))
        .groupBy(F.pmod("h", F.lit(SLICES)).alias("slice"))
        .agg(F.expr(f"approx_top_k(h, {PER_SLICE}, {SKETCH_ITEMS})").alias("top"))
        .select(F.inline("top"))
        .filter(F.col("count") > bound)
        .select("item")
        .collect()
    )
    return digest.isin([row["item"] for row in found]) if found else None


def resolve_heavy(df: DataFrame, keys: Sequence[str], heavy: Heavy) -> Column | None:
    return heavy_groups(df, keys) if isinstance(heavy, _Probe) else heavy


def ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    position: str | None = None,
    lags: Mapping[str, str] | None = None,
    leads: Mapping[str, str] | None = None,
    running: Mapping[str, str] | None = None,
    heavy: Heavy = PROBE,
) -> DataFrame:
    """Add row numbers, neighbour values and running sums per group, ascending by ``order``.

    ``position`` names a row number from 1; ``lags`` / ``leads`` map new columns
    to the columns of the previous / next row; ``running`` maps new columns to
    columns summed up to and including the row. ``heavy`` is a predicate that
    holds for whole groups (see :func:`heavy_groups`), None, or PROBE.
    """
    lags, leads, running = dict(lags or {}), dict(leads or {}), dict(running or {})
    cut = resolve_heavy(df, keys, heavy)
    if cut is None:
        return _plain(df, keys, order, position, lags, leads, running)
    return _plain(df.filter(~cut), keys, order, position, lags, leads, running).unionByName(
        _in_chunks(df.filter(cut), keys, order, position, lags, leads, running)
    )


def _plain(df, keys, order, position, lags, leads, running) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = {}
    if position:
        added[position] = F.row_number().over(window).cast("bigint")
    for name, source in lags.items():
        added[name] = F.lag(source).over(window)
    for name, source in leads.items():
        added[name] = F.lead(source).over(window)
    for name, source in running.items():
        added[name] = F.sum(source).over(so_far)
    return df.withColumns(added)


def _in_chunks(df, keys, order, position, lags, leads, running) -> DataFrame:
    original = df.columns

    # Rows equal in all order columns must be separable too, or a heap of copies
    # would stay in one chunk. Both the tie number and the chunk number are
    # written down before use, so no retry can see other values.
    numbered = checkpointed(df.withColumn(_TIE, F.monotonically_increasing_id()))
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(partitions, numbered.count() // CHUNK_ROWS + 1)
    rows = checkpointed(
        numbered.repartitionByRange(chunks, *keys, *order, _TIE).withColumn(
            _CHUNK, F.spark_partition_id()
        )
    )

    window = Window.partitionBy(_CHUNK, *keys).orderBy(*order, _TIE)
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.struct(F.lit(True).alias("there"), *[F.col(c).alias(n) for n, c in lags.items()])
    after = F.struct(F.lit(True).alias("there"), *[F.col(c).alias(n) for n, c in leads.items()])
    local = rows.withColumns(
        {
            _POS: F.row_number().over(window).cast("bigint"),
            "__before": F.lag(before).over(window),
            "__after": F.lead(after).over(window),
            **{f"__sum_{n}": F.sum(c).over(so_far) for n, c in running.items()},
        }
    )

    rank = F.struct(*order, _TIE)
    summary = rows.groupBy(_CHUNK, *keys).agg(
        F.count("*").alias("n"),
        F.min_by(after, rank).alias("first"),
        F.max_by(before, rank).alias("last"),
        *[F.sum(c).alias(f"total_{n}") for n, c in running.items()],
    )
    by_chunk = Window.partitionBy(*keys).orderBy(_CHUNK)
    earlier = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        F.col(_CHUNK).alias("c_chunk"),
        *[F.col(k).alias(f"c_{k}") for k in keys],
        F.sum("n").over(earlier).alias("c_rows"),
        F.lag("last").over(by_chunk).alias("c_before"),
        F.lead("first").over(by_chunk).alias("c_after"),
        *[F.sum(f"total_{n}").over(earlier).alias(f"c_sum_{n}") for n in running],
    ).filter(F.col("c_before").isNotNull() | F.col("c_after").isNotNull())

    # A cut between neighbouring chunks falls into one group at most, so ``carry``
    # has no more than 2 * (chunks - 1) rows: safe to broadcast at any data size.
    match = F.col(_CHUNK) == F.col("c_chunk")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"c_{k}"))
    whole = local.join(F.broadcast(carry), match, "left")

    added = []
    if position:
        added.append((F.col(_POS) + F.coalesce("c_rows", F.lit(0))).alias(position))
    previous, following = F.coalesce("__before", "c_before"), F.coalesce("__after", "c_after")
    added += [previous.getField(n).alias(n) for n in lags]
    added += [following.getField(n).alias(n) for n in leads]
    for n in running:
        mine, carried = F.col(f"__sum_{n}"), F.col(f"c_sum_{n}")
        total = F.when(mine.isNull(), carried).otherwise(mine + F.coalesce(carried, F.lit(0)))
        added.append(total.alias(n))
    return whole.select(*original, *added)
