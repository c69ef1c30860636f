"""Numbers and ranks over a whole table in an order, without a task that sees all rows.

Rows are range-partitioned by the order. Each partition numbers its own; one row per partition carries over
how many rows came before and where its first value began, which is worked out on as many rows as there are partitions.
Rows equal in what the rank counts may fill several partitions, so ties with a third of all rows are split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopwright.shared import stored


def _directed(names: Sequence[str]) -> list[Column]:
    """Sort columns; a minus in front means falling, with nulls last either way."""
    return [F.desc_nulls_last(n[1:]) if n.startswith("-") else F.asc_nulls_last(n) for n in names]


def numbered(df: DataFrame, by: Sequence[str], ties: Sequence[str], number: str = "number", rank: str = "rank", dense: str | None = None) -> DataFrame:
    """df with the row's number from 1 in the order ``by``, then ``ties``, and its rank by ``by`` alone.

    Equal rows have the number of the first of them as rank; ``dense`` names a rank without gaps. A minus before a
    name means falling order. Rows equal in both lists are numbered in any order. Nulls come last and are equal.
    """
    names = [n.lstrip("-") for n in by]
    order = _directed([*by, *ties])
    parts = df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    parts = stored(parts, "ranges")
    same = F.struct(*names)
    edges = (
        parts.groupBy("__part")
        .agg(
            F.count("*").alias("rows"),
            F.min(F.struct(*(_ascending(n) for n in by), same.alias("value"))).alias("first"),
            F.max(F.struct(*(_ascending(n) for n in by), same.alias("value"))).alias("last"),
            F.count_distinct(same).alias("values"),
        )
        .select("__part", "rows", "values", F.to_json("first.value").alias("first"), F.to_json("last.value").alias("last"))
    )
    # The rows of the last value in each partition; a few numbers per partition come to the driver.
    edges = edges.join(
        parts.withColumn("__value", F.to_json(same)).groupBy("__part", "__value").agg(F.count("*").alias("tail"))
        .select(F.col("__part"), F.col("__value").alias("last"), "tail"),
        ["__part", "last"],
    )
    carried, before, values, value, began = [], 0, 0, None, 0
    for edge in sorted(edges.collect(), key=lambda e: e["__part"]):
        goes_on = edge["first"] == value
        carried.append((edge["__part"], before, values - goes_on, began if goes_on else None))
        if not (goes_on and edge["values"] == 1):
            began = before + edge["rows"] - edge["tail"] + 1
        before, values, value = before + edge["rows"], values - goes_on + edge["values"], edge["last"]
    carry = _constants(df.sparkSession, carried)
    within = Window.partitionBy("__part").orderBy(*order)
    ranked = Window.partitionBy("__part").orderBy(*_directed(by))
    out = parts.join(F.broadcast(carry), "__part").withColumns(
        {"__number": F.row_number().over(within), "__rank": F.rank().over(ranked), "__dense": F.dense_rank().over(ranked)}
    )
    made = {
        number: F.col("__before") + F.col("__number"),
        rank: F.when(F.col("__rank") == 1, F.coalesce("__began", F.col("__before") + 1)).otherwise(F.col("__before") + F.col("__rank")),
    }
    if dense:
        made[dense] = F.col("__values") + F.col("__dense")
    return out.select(*(F.col(f"`{c}`") for c in df.columns), *(column.alias(name) for name, column in made.items()))


def _constants(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """What is carried over, as part of the plan."""
    kinds = {"__part": "int", "__before": "long", "__values": "long", "__began": "long"}
    made = [F.struct(*(F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(row, kinds.items()))) for row in rows or [(0, 0, 0, None)]]
    return spark.range(1).select(F.inline(F.array(*made)))


def _ascending(name: str) -> Column:
    """Something that sorts rising as the column does in its direction, nulls last: for numbers and times."""
    value = F.col(name.lstrip("-"))
    return F.struct(value.isNull(), -value if name.startswith("-") else value)
