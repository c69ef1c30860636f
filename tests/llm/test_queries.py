"""The named queries over whole test tables: against SQL, or against a plain version in Python."""

from __future__ import annotations

import html
import os
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from shopwright.llm import html_text
from shopwright.llm.queries import ORACLE, QUERIES
from tests.llm.test_near_dup import by_all_pairs

duckdb = pytest.importorskip("duckdb")

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.01")
SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def rows_of(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet").collect()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    got = QUERIES[name](spark, FOLDER)
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in got.select(columns).collect()))) == sorted(map(repr, want))


def test_all_queries_are_registered():
    named = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in named) == 1
    assert named["pipeline"] is corpus_pipeline.run
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("mark", ["article", "div"])
def test_main_texts_are_the_articles(spark, mark):
    """Also without the marks, where the slots of the hosts' wrappers tell the article."""
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").selectExpr(
        "page_id", "url", f"replace(replace(html, '<article>', '<{mark}>'), '</article>', '</{mark}>') as html"
    )
    got = {r["page_id"]: r for r in html_text.page_report(pages).collect()}
    rows = rows_of(spark, FOLDER, "pages")
    assert len(got) == len(rows)
    for page in rows:
        article = page["html"].split("<article>", 1)[1].split("</article>", 1)[0]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article))
        text = "\n".join(b for b in blocks if b)
        assert got[page["page_id"]]["text"] == text
        assert got[page["page_id"]]["n_chars"] == len(text)


def test_languages_of_documents_not_learned_from(spark):
    langs = {r["doc_id"]: r["lang"] for r in rows_of(spark, FOLDER, "documents")}
    rows = QUERIES["op5_language"](spark, FOLDER).collect()
    assert len(rows) == len(langs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    held = [r["lang_pred"] == langs[r["doc_id"]] for r in rows if r["held_out"]]
    assert np.mean(held) > 0.98
    assert np.mean([r["rejected"] for r in rows]) < 0.02


def check_packing(rows, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(texts)
    for doc_id, pieces in by_doc.items():
        ids = np.array([*tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for piece in sorted(pieces, key=lambda p: p["start"]):
            assert piece["start"] == at and piece["doc_tokens"] == len(ids)
            assert piece["ids_crc32"] == zlib.crc32(ids[at : at + piece["length"]])
            at += piece["length"]
        assert at == len(ids)
    padding = tokens = 0
    for pieces in by_sequence.values():
        at = 0
        for piece in sorted(pieces, key=lambda p: p["offset"]):
            assert piece["offset"] == at
            at += piece["length"]
        assert at <= 2048
        tokens += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    return padding / tokens


def test_packing_of_whole_table(spark):
    texts = {r["doc_id"]: r["text"] for r in rows_of(spark, FOLDER, "documents")}
    assert check_packing(QUERIES["op8_packing"](spark, FOLDER).collect(), texts) < 0.01


def test_near_duplicates_match_all_pairs(spark):
    texts = [(r["doc_id"], r["text"]) for r in rows_of(spark, SMALL, "documents")]
    got = {r["doc_id"]: r["component_id"] for r in QUERIES["op10_near_duplicates"](spark, SMALL).collect()}
    assert got == by_all_pairs(texts, 2)


def test_pipeline_stages(spark, tmp_path):
    """Each stage on what the one before it kept, against its effect."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        out.write.parquet(str(tmp_path / name))
        kept[name] = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert kept[name].columns == columns
            docs = kept[name]
    ids = {name: {r["doc_id"] for r in df.collect()} for name, df in kept.items()}
    assert ids["near_dup"] <= ids["line_dedup"] == ids["language"]
    texts = [(r["doc_id"], r["text"]) for r in kept["line_dedup"].collect()]
    assert ids["near_dup"] == set(by_all_pairs(texts, 5).values())
    benchmark = rows_of(spark, SMALL, "benchmark")

    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    windows = set()
    for item in benchmark:
        w = words(item["text"])
        n = min(10, len(w))
        windows |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()

    def hit(text):
        w = words(text)
        return any(tuple(w[i : i + 10]) in windows for i in range(len(w)))

    assert ids["decontaminate"] == {r["doc_id"] for r in kept["near_dup"].collect() if not hit(r["text"])}
    last = {r["doc_id"]: r["text"] for r in kept["decontaminate"].collect()}
    assert check_packing(kept["packing"].collect(), last) < 0.1
