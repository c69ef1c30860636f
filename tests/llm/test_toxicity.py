"""Toxicity: decoding against all readings, held-out results, and defined cases."""

from __future__ import annotations

import itertools
import math
import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from shopwright.llm import toxicity as tox

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.01")
DOCS = "doc_id long, text string, lang string, source string, toxic string, score string, alone int"
LABELS = "doc_id long, quality int, toxic int, text string, first long"
BAD = ["moron", "stupid", "worthless"]


def frames(spark, docs, labels):
    return (
        spark.createDataFrame([(i, t, "en", "s", "x", "y", 1) for i, t in docs], DOCS),
        spark.createDataFrame([(i, 1, x, "t", 0) for i, x in labels], LABELS),
    )


def report(spark, docs, labels, **parameters):
    rows = tox.toxicity_report(*frames(spark, docs, labels), **parameters).collect()
    return {r["doc_id"]: r for r in rows}


def costs_of(texts):
    counts = Counter()
    for text in texts:
        for word in "".join(c if tox.symbol(c) else " " for c in text.lower()).split():
            s = [0, 0, *map(tox.symbol, word), 0]
            counts.update(a * 4096 + b * 64 + c for a, b, c in zip(s, s[1:], s[2:]))
    return counts


def corpus(seed, n):
    pick = random.Random(seed)
    vocabulary = ["".join(pick.choice(["an", "te", "lo", "ri", "so", "mi"]) for _ in range(pick.randrange(1, 5))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        words = [pick.choice(vocabulary) for _ in range(pick.randrange(20, 80))]
        toxic = int(pick.random() < 0.3)
        for _ in range(4 * toxic):
            words.insert(pick.randrange(len(words)), pick.choice(BAD))
        docs.append((i, " ".join(words)))
        labels.append((i, toxic))
    return docs, labels


def test_counts_cover_all_documents(spark):
    texts = ["Stupid día!", "", None, "a", "x" * 5000 + " é", "the the\nthe", "ΣΑΣ ½ 10"] * 3
    docs, _ = frames(spark, list(enumerate(texts)), [(0, 0)])
    got = {r["code"]: r["n"] for r in tox.trigram_counts(docs).collect()}
    assert got == costs_of(t for t in texts if t)


def test_decoding_finds_the_cheapest_reading():
    docs, _ = corpus(1, 100)
    costs = tox.character_model(list(costs_of(t for _, t in docs).items()))
    decoder = tox.Decoder(costs)

    def price(path):
        total, context = 0.0, 0
        for number, _, cost in path:
            total += cost
            if number == 0:
                total, context = total + (costs[context * 64] if context else 0.0), 0
            elif number > 0:
                total, context = total + costs[context * 64 + number], context % 64 * 64 + number
        return total + (costs[context * 64] if context else 0.0)

    for token in ["m0ron", "st!!d", "lloo", "an-te", "t3l0", "s o n", "r1.s0", "w0rth1", "é33", "ssso"]:
        chars = [decoder.readings(c, token[i - 1 : i], token[i - 2 : i - 1]) for i, c in enumerate(token)]
        best = min(price(path) for path in itertools.product(*chars))
        words = decoder.restored(token)
        assert any(
            math.isclose(price(path), best, rel_tol=1e-5) and "".join(o for _, o, _ in path).split() == words
            for path in itertools.product(*chars)
        )


def test_disguised_words_are_read():
    docs, _ = corpus(2, 400)
    decoder = tox.Decoder(tox.character_model(list(costs_of(t for _, t in docs).items())))
    for written, meant in {
        "m0r0n": "moron", "s.t.u.p.i.d": "stupid", "stuuuupid": "stupid", "$tup1d": "stupid", "m o r o n": "moron",
        "wo*rthl3ss": "worthless", "s-t-u-p-!-d": "stupid",
    }.items():
        assert decoder.restored(written)[0] in (meant, meant.replace("ss", "s")), written


def test_long_runs_of_signs_take_no_square_time():
    decoder = tox.Decoder(tox.character_model([]))
    assert decoder.restored("y" * 200_000)
    assert decoder.restored("a " * 50_000 + "b")
    assert tox.tokens("x y z " * 10_000 + "word")["word"] == 1


def test_scores_tell_documents_apart(spark):
    docs, labels = corpus(3, 900)
    # Disguised words in documents without a label, and clean ones beside them.
    extra = [(5000 + i, f"{docs[i][1]} {w}") for i, w in enumerate(["m0r0n m0ron", "st.u.p.id st-upid", "w o r t h l e s s stuupid"])]
    clean = {i for i, x in labels if not x}
    extra = [(i, t) for i, t in extra]
    got = report(spark, docs + extra + [(6000, None), (6001, "")], [*labels, (9999, 1), (None, 1), (0, None)])
    assert len(got) == 905
    held = [i for i, _ in docs if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i]["held_out"] == (i in set(held)) for i, _ in docs)
    right = sum(got[i]["predicted"] == dict(labels)[i] for i in held)
    assert right >= 0.98 * len(held)
    assert all(got[i]["predicted"] == (1 if got[i]["score"] >= 0.3 else 0) for i in got)
    assert all(got[i]["predicted"] == 1 for i, _ in extra)
    lowest = min(r["score"] for r in got.values())
    assert got[6000]["score"] == got[6001]["score"] == lowest and 0 <= lowest
    assert clean


def test_copies_do_not_make_words_telling(spark):
    docs, labels = corpus(4, 300)
    # A third of all rows are near copies of one toxic text, with words that no other text has.
    page = "unique words of a single page that was copied very often and is named harmless by nobody moron"
    docs += [(10_000 + i, f"{page} {i}") for i in range(150)]
    labels += [(10_000 + i, 1) for i in range(150)]
    docs.append((20_000, docs[0][1] + " harmless unique page copied"))
    frame, given = frames(spark, docs, labels)
    weights = tox.learn(frame, given).weights
    assert "moron$" in weights
    assert not {"harmless$", "unique$", "copied$", "nobody$"} & set(weights)


def test_defined_cases(spark):
    assert report(spark, [], []) == {}
    one = report(spark, [(1, "some text")], [])
    assert 0 <= one[1]["score"] <= 1
    only = report(spark, [(1, "some text"), (2, None), (3, "moron")], [(1, 0), (3, 0)])
    assert {r["predicted"] for r in only.values()} == {0}
    frame, given = frames(spark, [(1, "some text")] * 3, [(1, 0), (1, 1)])
    assert tox.toxicity_report(frame, given).count() == 3


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_the_query_equals_scoring_in_one_process(spark):
    from shopwright.llm.queries import QUERIES

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = tox.learn(docs, labels)
    weighed = tox.Weighed(model.costs, model.weights)
    want = {}
    for row in docs.collect():
        x = np.array(tox.signs(row["text"] or "", weighed)) @ model.beta
        want[row["doc_id"]] = 1 / (1 + math.exp(-x))
    got = {r["doc_id"]: r for r in QUERIES["op13_toxicity"](spark, FOLDER).collect()}
    assert set(got) == set(want)
    assert all(math.isclose(got[i]["score"], s, rel_tol=1e-9) for i, s in want.items())
    known = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [i for i in known if got[i]["held_out"]]
    assert sum(got[i]["predicted"] == known[i] for i in held) >= 0.9 * len(held)


def test_dull_tokens_are_not_worked_on_again(monkeypatch):
    made, weights = [], {"vile$": 2.0, "vileness": 1.5, "rottenn": 3.0, "bad$": 2.5, "vile": 1.75}
    plain = tox.features
    costs = np.random.default_rng(4).uniform(0, 6, tox.SYMBOLS**3).astype(np.float32)

    def told(text):
        """The signs from all features of all words."""
        found, counts = tox.Words(costs), tox.tokens(text)
        known = {w: max((weights.get(f, 0.0) for f in plain(w)), default=0.0) for token in counts for w in found[token]}
        return known, sum(n for token, n in counts.items() for w in found[token] if known[w])

    texts = [
        "a vile word v1le (vile) vi!e vilest viper rottenness bad badly baad r o t t e n",
        "green meadows and quiet rivers, gr33n meadows: 1234 !!! " * 3,
        "",
        "a vile word again and bad bad bad",
    ]
    monkeypatch.setattr(tox, "features", lambda word: made.append(word) or plain(word))
    weighed = tox.Weighed(costs, weights)
    for text in texts * 2:
        known, places = told(text)
        got, strong = tox.signs(text, weighed), sorted((w for w in known.values() if w), reverse=True)
        assert got[1] == bool(strong)
        if strong:
            assert got[2] == sum(w * part for w, part in zip(strong[:3], (1.0, 0.5, 0.25)))
            assert got[3:5] == [math.log1p(len(strong)), math.log1p(places)]
    # Features are only made of words that begin like telling ones or are short, once a token.
    assert not {"green", "meadows", "quiet", "rivers", "word", "again"} & set(made) and made.count("bad") == 1
    # A token is kept once, with its telling words or without.
    assert "meadows" in weighed.dull and "vile" in weighed and not weighed.words and not weighed.dull & set(weighed)
