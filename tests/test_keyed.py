"""Tables kept by key: runs, merging without a shuffle, updates that leave other files alone."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from shopwright.operators import cells
from shopwright.sinks import keyed

CELLS = "row_key string, family string, qualifier string, value string, version long, put string"
ROWS = "id string, name string, n long"


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-") and "_keyed" not in d}


def table(spark, tmp_path, schema, key, splits, name):
    path = str(tmp_path / name)
    return path, keyed.create(spark, name, path, spark.createDataFrame([], schema).schema, key, splits, buckets=2)


def test_runs_are_merged_without_a_shuffle(spark, tmp_path):
    path, made = table(spark, tmp_path, CELLS, "row_key", ["k2", "k4", "k6"], "runs_a")
    want = {}
    for version in range(3):
        rows = [(f"k{i}", "f", q, f"{q}{version}", version, "") for i in range(version, 9) for q in ("a", "b")]
        keyed.add_run(spark.createDataFrame(rows, CELLS), made)
        want |= {(r[0], r[2]): r[3] for r in rows}
    wide = cells.wide_rows(made.rows())
    assert "Exchange" not in wide._jdf.queryExecution().executedPlan().toString()
    got = {(r["row_key"], c[2:]): v for r in wide.collect() for c, v in r["cells"].items()}
    assert got == want

    # A key range reads its partitions, and merging it leaves the files of the others.
    between = made.between("k2", "k4")
    assert {r["row_key"] for r in between.collect()} == {"k2", "k3"}
    assert {os.path.dirname(f).rsplit("=", 1)[1] for f in between.inputFiles()} == {"1"}
    before = files(path)
    keyed.compact_cells(made, ranges=[1], versions=1)
    after = files(path)
    assert {f for f in before if "key_range=1" not in f} == {f for f in after if "key_range=1" not in f}
    assert made.rows().filter("key_range = 1").count() == 4
    assert {(r["row_key"], c[2:]): v for r in cells.wide_rows(made.rows()).collect() for c, v in r["cells"].items()} == want

    # Another session's name for the same folder.
    again = keyed.open_table(spark, "runs_b", path)
    assert (again.splits, again.buckets, again.key) == (made.splits, 2, "row_key")
    assert again.rows().count() == made.rows().count()


def test_an_update_rewrites_only_the_ranges_it_touches(spark, tmp_path):
    path, made = table(spark, tmp_path, ROWS, "id", ["b", "c", "d"], "upserts")
    keyed.add_run(spark.createDataFrame([(f"{x}{i}", "old", i) for x in "abcd" for i in range(4)], ROWS), made)
    before = files(path)
    change = spark.createDataFrame([("b1", "new", 10), ("b9", "new", 90)], ROWS)
    assert keyed.upsert(change, made) == [1]
    once = sorted(map(tuple, made.rows().drop("key_range").collect()))
    assert {f for f in before if "key_range=1" not in f} <= files(path)
    assert not any(f in files(path) for f in before if "key_range=1" in f)
    assert keyed.upsert(change, made) == [1]
    assert sorted(map(tuple, made.rows().drop("key_range").collect())) == once
    assert len(once) == 17 and ("b1", "new", 10) in once and ("b0", "old", 0) in once

    assert keyed.update(spark.createDataFrame([("d2", 7), ("zz", 1)], "id string, n long"), made, ["n"]) == [3]
    got = {r["id"]: r["n"] for r in made.rows().collect()}
    assert got["d2"] == 7 and "zz" not in got and len(got) == 17
    assert keyed.upsert(spark.createDataFrame([], ROWS), made) == []


def test_null_keys_and_split_points(spark, tmp_path):
    _, made = table(spark, tmp_path, ROWS, "id", [], "one_range")
    keyed.add_run(spark.createDataFrame([(None, "x", 1), ("a", "y", 2)], ROWS), made)
    assert keyed.upsert(spark.createDataFrame([(None, "z", 3)], ROWS), made) == [0]
    assert made.rows().count() == 3
    keys = spark.createDataFrame([(f"k{i:05d}",) for i in range(5000)] + [("hot",)] * 3000 + [(None,)], "k string")
    splits = keyed.split_points(keys, 8, sample=2000)
    assert splits == sorted(set(splits)) and 3 <= len(splits) <= 7
    assert keyed.split_points(keys.limit(0), 8) == []
    expression = keyed._number(F.col("k"), splits)
    counts = [r["count"] for r in keys.filter("k <> 'hot'").groupBy(expression).count().collect()]
    assert max(counts) <= 2 * 8000 / 8
    with pytest.raises(ValueError, match="kept by one of"):
        keyed.compact_cells(made)
