"""Collocations against a plain version in Python, and their defined cases."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from shopwright.llm import collocations as co

DOCS = "doc_id long, text string, lang string, words string, own int, times long, phrase string, k int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "w", 1, 2, "p", 3) for i, (t, lang) in enumerate(rows)], DOCS)


def found(spark, rows, **parameters):
    got = co.collocations(frame(spark, rows), **parameters)
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in got.collect())


def plain(rows, max_words=5, least=100, top=2000):
    count, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = tuple(re.findall("[^ \t]+", piece))
            total[lang] += len(words)
            for k in range(1, max_words + 1):
                count.update((lang, words[i : i + k]) for i in range(len(words) - k + 1))
    candidates = {key: f for key, f in count.items() if len(key[1]) > 1 and f >= least}
    covered = set()
    for (lang, words), f in candidates.items():
        for k in range(2, len(words)):
            covered.update((lang, words[i : i + k]) for i in range(len(words) - k + 1) if 100 * f >= 100 * count[lang, words[i : i + k]])
    out = []
    for lang in {key[0] for key in candidates}:
        best = []
        for (of, words), a in candidates.items():
            if of == lang and (of, words) not in covered:
                cuts = []
                for k in range(1, len(words)):
                    left, right = count[lang, words[:k]], count[lang, words[k:]]
                    cuts.append((1000 * a * total[lang] // (left * right), k, left, right))
                score, _, left, right = min(cuts)
                best.append((-score, -a, " ".join(words).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def corpus(seed, n):
    """Random texts with copies, shared passages, long runs of one word and all kinds of breaks."""
    pick = random.Random(seed)
    vocabulary = ["a", "B", "the", "New", "york", "é", "ÉE", "中文", "x1", "city", "\u00a0", "hall"]
    breaks = [" "] * 12 + ["  ", "\t", ". ", ", ", "\n", "! ", " ; ", "\r\n", "?", ":"]
    passage = "new York city hall is open to the public every day of the year "
    texts = []
    for _ in range(n):
        kind = pick.random()
        if kind < 0.2 and texts:
            texts.append(pick.choice(texts))
        elif kind < 0.25:
            texts.append("a " * pick.randrange(400))
        else:
            text = "".join(pick.choice(vocabulary) + pick.choice(breaks) for _ in range(pick.randrange(60)))
            texts.append(passage * pick.randrange(3) + text + (passage if kind > 0.8 else ""))
    return [(t, pick.choice(["en", "en", None, "und", "de"])) for t in texts]


@pytest.mark.parametrize(("trigger", "longest"), [(3, 5), (1, 1024), (64, 1024), (1 << 40, 7)])
def test_equals_the_plain_version(spark, monkeypatch, trigger, longest):
    # Sums given on in many parts, and few places, so that phrases share them.
    monkeypatch.setattr(co, "HELD", 300)
    monkeypatch.setattr(co, "BITS", co.BITS if trigger == 64 else 1 << 15)
    monkeypatch.setattr(co, "TRIGGER", trigger)
    monkeypatch.setattr(co, "MAX_CHUNK", longest)
    rows = corpus(trigger, 150)
    for least, top in ((2, 2000), (6, 7)):
        assert found(spark, rows, least=least, top=top) == plain(rows, least=least, top=top)


def test_defined_cases(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, "en"), ("", "en"), (" \t.", None)], least=1) == []
    long = "the quick brown fox jumps over the lazy dog " * 20_000
    assert found(spark, [(long, "en"), ("y" * 200_000 + " z", "en")], least=2) == plain([(long, "en"), ("y" * 200_000 + " z", "en")], least=2)
    # A phrase as frequent as a longer one goes; languages are apart; a null language is "und".
    rows = [("new york city", "en")] * 3 + [("new york", None)] * 2 + [("new york", "und")]
    assert [(r[0], r[2], r[3]) for r in found(spark, rows, least=3)] == [("en", "new york city", 3), ("und", "new york", 3)]
    # More than two words of equal scores: the cut after fewer words counts.
    assert found(spark, [("p q r", "en")] * 4, least=4) == [("en", 1, "p q r", 4, 4, 4, 12, 3000)]


def test_sums_by_place_are_packed_without_loss():
    pick = random.Random(8)
    place = np.array([pick.randrange(1 << 22) for _ in range(5000)] + [7, 7, 7, (1 << 22) - 1])
    times = np.array([pick.choice([1, 2, 300, 1 << 40]) for _ in range(len(place))])
    want = Counter()
    for p, t in zip(place.tolist(), times.tolist()):
        want[p] += t
    got = {}
    for part, data in co._packed(place, times):
        at, total = co._unpacked(data)
        got |= dict(zip((at + (part << co.RANGE_BITS)).tolist(), total.tolist()))
    assert got == want
    assert list(co._packed(place[:0], times[:0])) == []


def test_copies_make_no_more_chunks(spark):
    once = frame(spark, [(" ".join(f"w{i % 97} v{i % 89}" for i in range(4000)), "en")])
    many = once.unionByName(once).unionByName(once)
    assert co.dictionary(many, 5, 64, 1024).count() == co.dictionary(once, 5, 64, 1024).count()
    assert {r["times"] % 3 for r in co.dictionary(many, 5, 64, 1024).collect()} == {0}
