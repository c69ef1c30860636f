"""Joins on overlapping spans and numbers over a whole table, against plain versions in Python."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shopwright.operators.customers import engagement_in_ranges
from shopwright.operators.intervals import in_ranges, overlapping
from shopwright.operators.numbering import numbered


def spans(pick, n, reach):
    """Spans of all lengths, some empty, some with nulls, some twice."""
    out = []
    for i in range(n):
        first = pick.randrange(-reach, reach)
        length = pick.choice([0, 0, 1, 2, 3, 17, 64, 65, pick.randrange(reach), 2 * reach, -1])
        out.append((pick.choice(["a", "a", "b", None]), first, pick.choice([first + length, first + length, None]), i))
    return out + out[:5]


@pytest.mark.parametrize("parts", [1, 2, 16])
def test_overlaps_equal_comparing_all(spark, parts):
    pick = random.Random(parts)
    rows, ranges = spans(pick, 120, 1000), spans(pick, 60, 1000)
    left = spark.createDataFrame(rows, "k string, s long, e long, i long")
    right = spark.createDataFrame([(k, s, e, i) for k, s, e, i in ranges], "k string, rs long, re long, j long")
    got = overlapping(left, right, ["k"], (F.col("s"), F.col("e")), (F.col("rs"), F.col("re")), parts)
    assert set(got.columns) == {"k", "s", "e", "i", "rs", "re", "j"}

    def good(k, s, e, _):
        return k is not None and s is not None and e is not None and s <= e

    want = sorted(
        (a[3], b[3]) for a in rows for b in ranges if good(*a) and good(*b) and a[0] == b[0] and a[1] <= b[2] and b[1] <= a[2]
    )
    assert sorted((r["i"], r["j"]) for r in got.collect()) == want


def test_an_empty_side_meets_nothing(spark):
    none = spark.createDataFrame([], "k string, s long, e long, i long")
    some = spark.createDataFrame([("a", 1, 9, 2)], "k string, rs long, re long, j long")
    for left, right in ((none, some), (none, none.withColumnsRenamed({"s": "rs", "e": "re", "i": "j"}))):
        assert overlapping(left, right, ["k"], (F.col("s"), F.col("e")), (F.col("rs"), F.col("re"))).count() == 0


def test_a_time_on_a_bound(spark):
    at = [datetime(2024, 1, 1) + timedelta(hours=h) for h in range(5)]
    rows = spark.createDataFrame([(1, t) for t in at], "user_id long, t timestamp")
    ranges = spark.createDataFrame([(1, at[1], at[3]), (1, at[2], at[2]), (2, at[0], at[4])], "user_id long, start timestamp, end timestamp")
    got = in_ranges(rows, ranges, ["user_id"], "t", "start", "end")
    assert sorted(r["t"] for r in got.collect()) == at[2:4]


def test_a_hot_user_is_spread_over_bins_without_a_cross_join(spark):
    day = datetime(2024, 1, 1)
    sessions = [(7, day + timedelta(minutes=i), "5") for i in range(3000)] + [(i, day, "1") for i in range(100, 200)]
    rows = spark.createDataFrame(sessions, "user_id long, start_time timestamp, duration_seconds string")
    ranges = spark.createDataFrame(
        [(7, day, day + timedelta(minutes=2999)), (150, day - timedelta(days=1), day + timedelta(days=1)), (8, day, day)],
        "user_id long, start timestamp, end timestamp",
    )
    got = engagement_in_ranges(ranges, rows)
    assert {(r["user_id"], r["session_count"], r["total_duration"]) for r in got.collect()} == {(7, 2999, 14995), (150, 1, 1), (8, 0, 0)}
    plan = got._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    joined = in_ranges(rows, ranges, ["user_id"], "start_time", "start", "end")
    tree = joined._jdf.queryExecution().executedPlan().toString()
    assert "__bin" in tree
    # The bins of the hot user's range.
    assert rows.filter("user_id = 7").select(F.expr("shiftright(unix_micros(start_time), 38 - 4)")).distinct().count() >= 8


def test_a_small_file_of_many_bins_is_not_sent_through_the_driver(spark, tmp_path):
    # A user's number takes a few bytes in the file, its ranges' bins a thousand; Spark only knows the former.
    spark.range(2000).withColumnRenamed("id", "user_id").write.parquet(str(tmp_path / "users"))
    spark.sql("select id % 500 user_id, timestamp_seconds(id * 60) start_time, timestamp_seconds(id * 60 + 9) end_time, '9' duration_seconds from range(2000)"
              ).write.parquet(str(tmp_path / "rows"))
    users, rows = spark.read.parquet(str(tmp_path / "users")), spark.read.parquet(str(tmp_path / "rows"))
    ranges = users.select("user_id", F.timestamp_seconds(F.lit(0)).alias("start"), F.timestamp_seconds(F.lit(90_000)).alias("end"))
    for during, sessions in ((None, 1500), ("end_time", 1501)):
        got = engagement_in_ranges(ranges, rows, during=during)
        plan = got._jdf.queryExecution().executedPlan().toString()
        joins = [line for line in plan.splitlines() if "Join" in line and "__bin" in line]
        assert joins and all("SortMergeJoin" in line for line in joins)
        assert got.agg(F.sum("session_count")).first()[0] == sessions
    found = in_ranges(rows, ranges, ["user_id"], "start_time", "start", "end")
    assert len(found.collect()) == 1500
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()


def ranked(rows):
    order = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    out, rank, dense = [], 0, 0
    for number, (name, value) in enumerate(order, 1):
        if number == 1 or value != order[number - 2][1]:
            rank, dense = number, dense + 1
        out.append((name, value, number, rank, dense))
    return sorted(out, key=repr)


@pytest.mark.parametrize("partitions", ["1", "3", "16"])
def test_ranks_with_ties_over_many_partitions(spark, partitions):
    pick = random.Random(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        for rows in (
            # A third and more are equal, in the middle, at the start and at the end.
            [(f"u{i:04d}", pick.choice([5.0, 5.0, 1.5, 2.5, 9.0, None])) for i in range(600)],
            [(f"u{i:04d}", 0.0) for i in range(300)],
            [(f"u{i:04d}", float(i)) for i in range(300)],
            [("u1", None), ("u2", None), ("u3", 1.0)],
            [],
        ):
            df = spark.createDataFrame(rows, "name string, value double")
            got = numbered(df, ["-value"], ["name"], dense="dense")
            assert sorted((tuple(r) for r in got.collect()), key=repr) == ranked(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_sums_of_money_are_those_of_decimals(spark):
    from shopwright.functions import money, money_sum

    pick = random.Random(9)
    values = [round(pick.uniform(-1e6, 1e6), 2) for _ in range(500)] + [0.1 + 0.2, 1e-7, 5e-7, 1 / 3, 4.99e9, 5.6e9, 1e20, -0.0, 0.005, None]
    values += [123456789.123456, -1e-6, 9007199254740993.0]
    rows = [(i % 7, v) for i, v in enumerate(values)] + [(8, None), (9, 0.01)]
    df = spark.createDataFrame(rows, "k int, v double")
    got = df.groupBy("k").agg(money_sum("v").alias("a"), F.sum(money("v")).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in got)
    assert got and df.agg(money_sum("v").alias("a")).schema["a"].dataType.simpleString() == "decimal(38,6)"
    exact = df.select(F.col("v").cast("decimal(28,6)").alias("v"))
    assert exact.agg(money_sum("v").alias("a")).first()["a"] == exact.agg(F.sum("v").alias("a")).first()["a"]
    for bad in (float("nan"), float("inf")):
        with pytest.raises(Exception, match="not finite"):
            spark.createDataFrame([(bad,)], "v double").agg(money_sum("v")).collect()
