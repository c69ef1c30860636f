"""Hard negatives against a plain version in Python, and their defined cases."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopwright.llm import hard_negatives as hn

ROWS = "vec_id long, label int, vector array<double>, mark string, dims long, is_anchor string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "m", 1, "x") for r in rows], ROWS)


def mined(spark, rows, **parameters):
    found = hn.hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0, **parameters)
    return sorted(tuple(r) for r in found.collect())


def plain(rows, positives=5, negatives=10, low=30, high=90):
    usable = [
        (i, label, [math.floor(256 * x) for x in v])
        for i, label, v in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, label, v in {(i, label, tuple(v)) for i, label, v in usable if i % 100 == 0}:
        scored = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in usable if len(w) == len(v)]
        near = sorted(r for r in scored if r[2] == label and r[1] != i)[:positives]
        far = sorted(r for r in scored if r[2] != label)
        for p, j, _ in near:
            inside = [(n, k) for n, k, _ in far if low * -p <= 100 * -n <= high * -p][:negatives]
            out += [(i, j, rank, k, -p, -n) for rank, (n, k) in enumerate(inside, 1)]
    return sorted(out)


def test_equals_the_plain_version(spark, monkeypatch):
    # Many small blocks, so that what a block gives on is put together from many.
    monkeypatch.setattr(hn, "BLOCK_BYTES", 8 * 8 * 16)
    monkeypatch.setattr(hn, "ANCHOR_BYTES", 8 * 8 * 2)
    rng = np.random.default_rng(5)
    rows = [(i, int(rng.integers(3)), [float(x) for x in np.round(rng.normal(0.1, 0.2, 8), 2)]) for i in range(900)]
    # One label holds a third of all rows, all of them copies.
    rows += [(1000 + i, 7, [0.1] * 8) for i in range(450)]
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, rows, positives=2, negatives=3, low=0, high=100) == plain(rows, 2, 3, 0, 100)


def test_defined_cases(spark):
    assert mined(spark, []) == []
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 1, [0.9, 0.1]), (3, 2, [0.5, 0.5]), (3, 2, [0.5, 0.5]),
        (4, 2, [0.8, 0.0]), (5, None, [0.8, 0.0]), (6, 2, None), (7, 2, [nan, 0.0]), (8, 2, [inf, 0.0]),
        (9, 2, [None, 0.5]), (None, 2, [0.5, 0.5]), (10, 2, [0.5]), (100, 3, []), (101, 3, []), (102, 4, []),
        (200, 5, [0.3, 0.3]), (200, 5, [0.3, 0.3]), (200, 6, [0.3, 0.3]), (201, 6, [0.4, 0.4]), (202, 5, [0.4, 0.4]),
        (300, 9, [-1.0, 0.0]), (301, 9, [1.0, 0.0]),
    ]
    want = plain(rows)
    assert mined(spark, rows) == want
    # Zero scores lie in the window of a zero score; a row that is there twice counts twice.
    assert (100, 101, 1, 102, 0, 0) in want
    assert [r[3] for r in want if r[:2] == (0, 1)].count(3) == 2


def test_scores_stay_exact_where_floats_do_not(spark):
    big, one = float(2**21), 1 / 256
    rows = [(0, 1, [big, one]), (1, 1, [big, 3 * one]), (2, 1, [big, 5 * one]), (3, 2, [big / 2, 7 * one]), (4, 2, [big / 2, 9 * one])]
    got = mined(spark, rows)
    assert got == plain(rows)
    assert {r[4] for r in got} == {2**58 + 3, 2**58 + 5}
    with pytest.raises(Exception, match="does not fit"):
        mined(spark, [(0, 1, [1e30]), (1, 1, [1e30])])
