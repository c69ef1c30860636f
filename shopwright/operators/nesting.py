"""Rows to nested arrays and back, with a bound on every array."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopwright.operators.ordered import PROBE, Heavy, ordered

# Longest array in one nested row. A longer group continues in further parts.
PART_ROWS = 1_000


def nest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    fields: Sequence[str],
    into: str,
    *,
    part_rows: int = PART_ROWS,
    heavy: Heavy = PROBE,
) -> DataFrame:
    """Collect ``fields`` of each group into an array of structs sorted by ``order``.

    A group gives one row per ``part_rows`` members, numbered by ``part`` from 0,
    so no row grows with the size of its group and nothing is left out.
    """
    placed = ordered(df, keys, order, position="__pos", heavy=heavy).withColumn(
        "part", F.floor((F.col("__pos") - 1) / part_rows).cast("int")
    )
    member = F.struct("__pos", *fields)
    return (
        placed.groupBy(*keys, "part")
        .agg(F.array_sort(F.collect_list(member)).alias(into))
        .withColumn(into, F.transform(into, lambda m: F.struct(*[m[f].alias(f) for f in fields])))
    )


def gathered(df: DataFrame, keys: Sequence[str], array: str) -> DataFrame:
    """One row per group with all parts of its array put together, for groups that fit into a row."""
    whole = F.sort_array(F.collect_list(F.struct("part", array)))
    return df.groupBy(*keys).agg(F.flatten(F.transform(whole, lambda p: p[array])).alias(array))


def unnest(df: DataFrame, array: str, *, index: str | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """One row per array element with the struct fields as columns.

    Rows whose array is null or empty drop out. ``index`` names the position in
    the whole group from 0; a ``part`` column, if there is one, is counted in.
    """
    rest = [c for c in df.columns if c != array]
    if index is None:
        return df.select(*rest, F.explode(array).alias("__m")).select(*rest, "__m.*")
    offset = F.col("part") * part_rows if "part" in rest else F.lit(0)
    return df.select(*rest, F.posexplode(array).alias("__i", "__m")).select(
        *rest, (F.col("__i") + offset).cast("bigint").alias(index), "__m.*"
    )
