"""Near duplicates against all pairs, and the defined cases."""

from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import SparkSession

from shopwright.llm import grams, near_dup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, keys string"


def frame(spark: SparkSession, texts: list[tuple[int | None, str | None]]):
    return spark.createDataFrame([(i, t, None, "s", 0, "x", "y") for i, t in texts], SCHEMA)


def shingles(text: str | None, n: int) -> frozenset[tuple[str, ...]]:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*(words[i:] for i in range(n))))


def by_all_pairs(texts: list[tuple[int, str | None]], n: int) -> dict[int, int]:
    parent = {i: i for i, _ in texts}

    def top(i: int) -> int:
        return i if parent[i] == i else top(parent[i])

    sets = {i: shingles(t, n) for i, t in texts}
    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            low, high = sorted((top(a), top(b)))
            parent[high] = low
    return {i: top(i) for i in parent}


def edited(rng: random.Random, words: list[str], share: float) -> str:
    out = []
    for word in words:
        if rng.random() < share:
            kind = rng.randrange(3)
            out += [[], [f"w{rng.randrange(400)}"], [word, f"w{rng.randrange(400)}"]][kind]
        else:
            out.append(word)
    return " ".join(out)


def test_groups_of_edited_copies_match_all_pairs(spark):
    rng = random.Random(3)
    texts, number = [], 0
    for size in (160, 60, 40, 12):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(60, 200))]
        for _ in range(size):
            texts.append((number, edited(rng, words, rng.choice([0.0, 0.02, 0.05, 0.08, 0.1, 0.15]))))
            number += 1
    for _ in range(60):
        texts.append((number, " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(0, 80)))))
        number += 1
    rng.shuffle(texts)
    for n in (2, 5):
        got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(frame(spark, texts), n).collect()}
        assert got == by_all_pairs(texts, n)


def test_defined_cases(spark):
    long = " ".join(f"v{i % 7919}" for i in range(60_000))
    texts = [
        (5, "one two three"),
        (5, "one two three"),
        (3, "ONE  two\nthree"),
        (7, None),
        (8, ""),
        (9, " \t\n"),
        (10, "solo"),
        (11, "Solo"),
        (12, long),
        (13, long + " end"),
        (None, "only here"),
        (14, "É two three"),
        (15, "é two three"),
    ]
    rows = sorted(map(tuple, near_dup.near_duplicates(frame(spark, texts), 2).collect()), key=repr)
    assert sorted(rows, key=repr) == sorted(
        [
            (5, 2, 3, False),
            (5, 2, 3, False),
            (3, 2, 3, True),
            (7, 0, 7, True),
            (8, 0, 8, True),
            (9, 0, 9, True),
            (10, 1, 10, True),
            (11, 1, 10, False),
            (12, len(shingles(long, 2)), 12, True),
            (13, len(shingles(long + " end", 2)), 12, False),
            (None, 1, None, True),
            (14, 2, 14, True),
            (15, 2, 15, True),
        ],
        key=repr,
    )


def test_filter_keeps_one_row_of_each_group_and_all_columns(spark):
    texts = [(2, "a b c d e f"), (2, "a b c d e f"), (1, "a b c d e f"), (4, "x y z"), (None, "n o"), (6, None)]
    kept = near_dup.drop_near_duplicates(frame(spark, texts))
    assert kept.columns == frame(spark, []).columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([1, 4, 6, None], key=repr)


def test_empty_table(spark):
    assert near_dup.near_duplicates(frame(spark, [])).count() == 0
    assert near_dup.drop_near_duplicates(frame(spark, [])).count() == 0


def test_sketches_fill_every_coordinate_and_estimate_similarity():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 1 << 62, 3000).astype(np.uint64)
    for shared, alone in ((1, 0), (3, 1), (200, 25), (800, 100)):
        a = np.sort(np.concatenate((pool[:shared], pool[1000 : 1000 + alone])))
        b = np.sort(np.concatenate((pool[:shared], pool[2000 : 2000 + alone])))
        values, first = np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)])
        made = near_dup.sketches(values, first, 640)
        assert (made != ~np.uint64(0)).all()
        similarity = shared / (shared + 2 * alone)
        assert abs((made[0] == made[1]).mean() - similarity) < 0.1


def test_small_batches_hold_inside_only(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    with pytest.raises(ValueError), grams.small_batches(spark, 7):
        assert spark.conf.get(name) == "7"
        raise ValueError
    assert spark.conf.get(name) == before
