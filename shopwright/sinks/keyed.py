"""Tables kept by key: sorted runs, merged as they are read; updates rewrite only the key ranges they touch.

Such a table is cut at fixed split points into key ranges, which are its partitions, and by a hash of the key
into a fixed number of buckets. Both are stated in the table's folder, so that any session can open it. Every load adds
a run: one sorted file per range and bucket. Rows of one key always lie in one bucket, so that whatever is grouped by key is
merged without a shuffle, and a key range reads its partitions alone. An update or a compaction reads the ranges it
touches and replaces these partitions; files of all others stay as they are.
"""

from __future__ import annotations

import bisect
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopwright.operators.cells import CELL, retain_versions
from shopwright.shared import discard_at_end, new_folder, stored

RANGE = "key_range"
SAMPLE_KEYS = 10_000
_STATED = "_keyed_table"


@dataclass(frozen=True)
class KeyedTable:
    """A table by key: its name in the session, key column, split points and number of buckets."""

    spark: SparkSession
    name: str
    key: str
    splits: tuple[str, ...]
    buckets: int

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def columns(self) -> list[str]:
        return [c for c in self.rows().columns if c != RANGE]

    def ranges_between(self, first: str | None, stop: str | None) -> list[int]:
        """Numbers of the ranges that hold keys with first <= key < stop; None is an open end."""
        low = 0 if first is None else bisect.bisect_right(self.splits, first)
        high = len(self.splits) if stop is None else bisect.bisect_left(self.splits, stop)
        return list(range(low, high + 1))

    def between(self, first: str | None, stop: str | None) -> DataFrame:
        """Rows with first <= key < stop; other ranges' files are not read."""
        found = self.rows().filter(F.col(RANGE).isin(self.ranges_between(first, stop)))
        if first is not None:
            found = found.filter(F.col(self.key) >= first)
        return found if stop is None else found.filter(F.col(self.key) < stop)


def split_points(keys: DataFrame, n: int, sample: int = SAMPLE_KEYS) -> list[str]:
    """Up to n - 1 keys that cut the table into parts of about equal size, from the ``sample`` rows of smallest hash.

    ``keys`` has one column of strings. Fewer points come back where a key holds more than a part.
    """
    key = keys.columns[0]
    # Rows of one key have one hash, so they are told apart by a second one over their place.
    drawn = keys.filter(F.col(key).isNotNull()).withColumn("__at", F.xxhash64(key, F.monotonically_increasing_id()))
    taken = sorted(r[0] for r in drawn.orderBy("__at", key).limit(sample).select(key).collect())
    return sorted({taken[i * len(taken) // n] for i in range(1, n)} - set(taken[:1])) if taken else []


def _number(key: Column, splits: Sequence[str], low: int = 0) -> Column:
    """How many split points are no greater than the key, found by halving; 0 for a null key."""
    if not splits:
        return F.lit(low)
    middle = len(splits) // 2
    return F.when(key >= splits[middle], _number(key, splits[middle + 1 :], low + middle + 1)).otherwise(
        _number(key, splits[:middle], low)
    )


def create(
    spark: SparkSession, name: str, path: str, schema: T.StructType, key: str, splits: Sequence[str], buckets: int = 8
) -> KeyedTable:
    """An empty table at ``path``; what it is cut by is written beside its data."""
    splits = tuple(sorted(set(splits)))
    stated = [(key, list(splits), buckets, schema.json())]
    spark.createDataFrame(stated, "key string, splits array<string>, buckets int, schema string").coalesce(1).write.json(f"{path}/{_STATED}")
    return open_table(spark, name, path)


def open_table(spark: SparkSession, name: str, path: str) -> KeyedTable:
    """The table at ``path`` under a name in this session."""
    stated = spark.read.schema("key string, splits array<string>, buckets int, schema string").json(f"{path}/{_STATED}").first()
    schema = T.StructType.fromJson(json.loads(stated["schema"]))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    key = stated["key"]
    spark.sql(
        f"CREATE TABLE `{name}` ({columns}, {RANGE} INT) USING parquet PARTITIONED BY ({RANGE}) "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {stated['buckets']} BUCKETS LOCATION '{path}'"
    )
    spark.sql(f"MSCK REPAIR TABLE `{name}`")
    return KeyedTable(spark, name, key, tuple(stated["splits"]), stated["buckets"])


def _placed(df: DataFrame, table: KeyedTable) -> DataFrame:
    number = _number(F.col(table.key), table.splits)
    placed = df.select(*table.columns(), number.cast("int").alias(RANGE))
    # One task per range and bucket; each writes one sorted file.
    return placed.repartition(RANGE, F.pmod(F.hash(table.key), F.lit(table.buckets)))


def add_run(df: DataFrame, table: KeyedTable) -> None:
    """Add the rows as a sorted run. A row that is added twice is there twice until its ranges are merged."""
    _placed(df, table).write.mode("append").insertInto(table.name)


def _replace(df: DataFrame, table: KeyedTable) -> None:
    """Put df in the place of the ranges that it has rows in.

    The rows are written apart first, as they come from the files that go. Replacing partitions is a
    setting of a session, so it is made in one of its own.
    """
    path = new_folder(table.spark, "merged")
    df.select(*table.columns()).write.parquet(path)
    discard_at_end(table.spark, path)
    own = table.spark.newSession()
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    rows = own.read.schema(df.select(*table.columns()).schema).parquet(path)
    _placed(rows, table).write.mode("overwrite").insertInto(table.name)
    table.spark.catalog.refreshTable(table.name)


def touched(df: DataFrame, table: KeyedTable) -> list[int]:
    """Numbers of the ranges that hold keys of df; as many as there are split points at most."""
    number = _number(F.col(table.key), table.splits)
    return sorted(r[0] for r in df.select(number.alias("n")).distinct().collect())


def upsert(df: DataFrame, table: KeyedTable) -> list[int]:
    """Replace rows of the same key and add those of new keys; returns the numbers of the rewritten ranges.

    Keys in df are distinct; a null key replaces nothing and is added. Loading one batch again changes nothing.
    """
    df = stored(df.select(*table.columns()), "upsert")
    ranges = touched(df, table)
    if not ranges:
        return []
    old = table.rows().filter(F.col(RANGE).isin(ranges)).drop(RANGE)
    kept = old.join(df.select(table.key), table.key, "left_anti")
    _replace(kept.unionByName(df), table)
    return ranges


def update(df: DataFrame, table: KeyedTable, columns: Sequence[str]) -> list[int]:
    """Set ``columns`` of the rows whose key df has; other keys are not added. Returns the rewritten ranges."""
    given = df.select(table.key, *(F.col(c).alias(f"__{c}") for c in columns), F.lit(True).alias("__given"))
    given = stored(given, "update")
    ranges = touched(given, table)
    if not ranges:
        return []
    old = table.rows().filter(F.col(RANGE).isin(ranges)).drop(RANGE)
    new = {c: F.when(F.col("__given"), F.col(f"__{c}")).otherwise(F.col(c)) for c in columns}
    _replace(old.join(given, table.key, "left").withColumns(new), table)
    return ranges


def fold(states: DataFrame, table: KeyedTable, merge: dict[str, Column]) -> list[int]:
    """Fold a batch's aggregate states into the stored ones by key; returns the numbers of the rewritten ranges.

    ``merge`` says for every column but the key how states go together, as sum, min or max do. A batch counts
    each time it is folded. Null keys are one group.
    """
    states = stored(states.select(*table.columns()), "states")
    ranges = touched(states, table)
    if ranges:
        old = table.rows().filter(F.col(RANGE).isin(ranges)).drop(RANGE)
        merged = old.unionByName(states).groupBy(table.key).agg(*(how.alias(c) for c, how in merge.items()))
        _replace(merged, table)
    return ranges


def compact_cells(table: KeyedTable, ranges: Sequence[int] | None = None, versions: int = 3) -> None:
    """Merge the runs of a table of cells, all or some of its ranges, into one that keeps the newest versions.

    The rank runs within buckets, without a shuffle.
    """
    if table.key not in CELL:
        raise ValueError(f"a table of cells is kept by one of {CELL}")
    rows = table.rows() if ranges is None else table.rows().filter(F.col(RANGE).isin(list(ranges)))
    _replace(retain_versions(rows.drop(RANGE), versions), table)
