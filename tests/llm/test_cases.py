"""Defined results for nulls, empty and long texts, ties, repeated rows, empty tables and extra columns."""

from __future__ import annotations

import public_tokenizers
import pytest

from shopwright.llm import (
    chat,
    decontaminate,
    html_text,
    language,
    licenses,
    line_dedup,
    packing,
    quality,
    url_filter,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, words string, row string, _text string"
LONG = "the quick brown fox jumps over the lazy dog " * 12_000


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0, "w", "r", "t") for i, t, lang in rows], DOCS)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- HTML --------------------------------------------------------------------

PAGES = "page_id long, url string, html string, host string, wrapper string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "h", "w") for i, u, h in rows], PAGES)


def page(body, extra=""):
    return (
        f"<html><head><title>no</title></head><body><header><h2>Site</h2></header><nav><a>menu</a></nav>{extra}"
        f"<article class='post'><h1>Head &amp; <i>more</i></h1>{body}</article><aside>side</aside>"
        "<div id='comments'><p>reader</p></div><footer>foot</footer></body></html>"
    )


def test_html_cases(spark):
    rows = [
        (1, "http://a.com/1", page("<p>one\n  two</p><p>three<br>four</p>")),
        (2, "http://a.com/2", page("<p>only&nbsp;one &#233;</p><div class='ad'>buy</div>", "<div class=notice>cookies</div>")),
        (2, "http://a.com/2", page("<p>only&nbsp;one &#233;</p><div class='ad'>buy</div>", "<div class=notice>cookies</div>")),
        (3, "http://a.com/3", None),
        (4, None, "<p>loose <b>text"),
        (5, "no scheme", ""),
        (6, "http://b.com/", "<article><p>open <p>para<ul><li>x<li>y</ul><form><p>f</form><script>1<2</script><p a='>'>end"),
        (7, "http://c.com/", page("<p>" + LONG + "</p>")),
        (None, "http://a.com/4", page("<!-- <p>no</p> --><section class='comments'><p>c</p></section><p>last</p>")),
    ]
    got = {(r["page_id"], r["text"]) for r in html_text.page_report(pages(spark, rows)).collect()}
    head = "Head & more"
    assert got == {
        (1, f"{head}\none two\nthree four"),
        (2, f"{head}\nonly one é"),
        (3, ""),
        (4, "loose text"),
        (5, ""),
        (6, "open\npara\nx\ny\nend"),
        (7, f"{head}\n{LONG.strip()}"),
        (None, f"{head}\nlast"),
    }
    assert html_text.page_report(pages(spark, rows)).count() == len(rows)
    assert html_text.page_report(pages(spark, [])).count() == 0


def test_wrapper_has_optional_and_repeated_parts_and_slots():
    made = None
    for body in ("<p>a</p><p>b</p>", "<h2>x</h2><p>c</p>", "<h2>x</h2><p>c</p><h2>y</h2><p>d</p>"):
        own = html_text.page_wrapper(html_text.page_tree(f"<article><h1>Same</h1>{body}</article>"))
        made = html_text._merged(made, own) if made else own
    text = html_text.expression(made)
    assert "<h1> 'Same' </>" in text
    assert "( <p> TEXT </> )+" in text
    assert "?" in text


def test_pages_without_article_use_running_text(spark):
    def plain(i):
        text = " ".join(f"w{i}{j}" for j in range(80))
        return f"<body><div class='top'><div>Shop | Blog</div></div><div class='x'><p>{text}</p><p>{text} b</p></div></body>"

    got = html_text.page_report(pages(spark, [(i, f"http://d.com/{i}", plain(i)) for i in range(4)])).collect()
    for r in got:
        text = " ".join(f"w{r['page_id']}{j}" for j in range(80))
        assert r["text"] == f"{text}\n{text} b"


def test_copies_and_equal_beginnings_keep_their_text(spark):
    same = "word " * 30
    rows = [(i, "http://copy.com/", f"<body><div class='x'><p>{same}</p></div><div class='y'>Shop</div></body>") for i in range(4)]
    rows += [(10 + i, f"http://begin.com/{i}", f"<body><div class='x'><p>{same}{i}</p></div><div class='y'>Shop</div></body>") for i in range(4)]
    got = {r["page_id"]: r["text"] for r in html_text.page_report(pages(spark, rows)).collect()}
    assert got == {i: same.strip() for i in range(4)} | {10 + i: f"{same}{i}" for i in range(4)}


def test_content_is_chosen_for_each_page(spark):
    def body(start, end, i):
        return f"<body><div class='top'>Shop</div>{start}<p>text of page {i}</p>{end}</body>"

    forms = [("<article>", "</article>"), ("<main>", "</main>"), ("<div class='content'>", "</div>"), ("<div class='x'>", "</div>"), ("", "")]
    rows = [(i, f"http://e.com/{i}", body(*form, i)) for i, form in enumerate(forms)]
    # Unrelated sites without a host, and two rows of one key of which the second holds the text.
    rows += [(10, None, "<article><p>text of page 10</p></article>"), (11, "", "<div class='y'><p>text of page 11</p></div>")]
    row = "<div class='row'>menu</div><hr><div class='row'><div class='z'><p>text of page {0}</p></div></div>"
    rows += [(20 + i, f"http://f.com/{i}", row.format(20 + i)) for i in range(4)]
    got = {r["page_id"]: r["text"] for r in html_text.page_report(pages(spark, rows)).collect()}
    want = {r[0]: f"text of page {r[0]}" for r in rows}
    assert got == want


def text_of(body):
    return html_text.page_text(f"<html><body>{body}</body></html>", None)


def test_names_inside_an_article_are_judged_as_a_whole():
    kept = (
        "<section id='search-algorithms'><h2 id='related-work'>a</h2><p class='market-share'>b</p></section>"
        "<p title=it's>Hello</p><p>it's me</p><p>x <math><mi>y</mi><mo>=</mo><mn>2</mn></math> z</p>"
    )
    gone = (
        "<div class='share-buttons'>s</div><div class='ad'>t</div><ul class=discussion><li>u</ul><div id='comments'>v</div>"
        "<div class='newsletter signup'>w</div><div role=search>q</div><div data-id='ad'></div>"
    )
    assert text_of(f"<article>{kept}{gone}</article>") == "a\nb\nHello\nit's me\nx y=2 z"
    assert text_of(f"<div class='has-sidebar'><article><p>a</p></article></div>") == "a"


@pytest.mark.parametrize("depth", [1, 30, 45, 500, 1500])
def test_depth_makes_no_difference(spark, depth):
    def deep(i):
        nest = "<div>" * depth + f"<p>deep {i}</p><aside>no</aside><p>two {i}</p>" + "</div>" * depth
        return f"<body><div class=a>Shop</div><article>{nest}<p>tail {i}</p></article><div>Shop</div></body>"

    for tags in (("article", "article"), ("article", "section")):
        rows = [(i, f"http://deep.com/{i}", deep(i).replace(*tags)) for i in range(4)]
        got = {r["page_id"]: r["text"] for r in html_text.page_report(pages(spark, rows)).collect()}
        if tags[1] == "article":
            assert got == {i: f"deep {i}\ntwo {i}\ntail {i}" for i in range(4)}
        else:
            assert all(f"deep {i}\ntwo {i}" in got[i] and "Shop" not in got[i] and "no" not in got[i].split() for i in got)


def test_many_different_parts_make_no_difference(spark):
    def many(i, n):
        parts = "".join(f"<h{j % 5 + 2} class='{chr(97 + j % 26) * (j // 26 + 1)}'>head {i} {j}</h{j % 5 + 2}><p>text {i} {j} of it</p>" for j in range(n))
        return f"<body><div class=menu-bar>Menu</div><div class=zz><p>Shop notice</p></div><div class=x>{parts}</div></body>"

    for n in (10, 60, 300):
        rows = [(i, f"http://many.com/{i}", many(i, n + i)) for i in range(5)]
        got = {r["page_id"]: r["text"] for r in html_text.page_report(pages(spark, rows)).collect()}
        assert got == {i: "\n".join(f"head {i} {j}\ntext {i} {j} of it" for j in range(n + i)) for i in range(5)}


def test_constants_of_a_host_are_template(spark):
    rows = [(i, f"http://menu.com/{i}", f"<body><div>Home Shop Cart and a long line of constant words that is longer</div><p>own {i}</p><p>also {i}</p></body>") for i in range(10)]
    rows += [(20 + i, f"http://art.com/{i}", f"<article><div>Advertisement</div><p>own {i}</p></article>") for i in range(10)]
    rows += [(40 + i, f"http://two.com/{i}", f"<article><div>Only twice</div><p>own {i}</p></article>") for i in range(2)]
    got = {r["page_id"]: r["text"] for r in html_text.page_report(pages(spark, rows)).collect()}
    assert got == (
        {i: f"own {i}\nalso {i}" for i in range(10)} | {20 + i: f"own {i}" for i in range(10)}
        | {40 + i: f"Only twice\nown {i}" for i in range(2)}
    )


def accepts(part, tree):
    """Brute force: whether an element's parts can be read by the wrapper's, trying every way."""

    def parts_of(element):
        return [p for p in element[1] if not isinstance(p, str) or p.split()]

    def run(kids, found, at):
        """All places in found that kids can read up to from at on."""
        ends = {at}
        for kid in kids:
            ends = {e for start in ends for e in once(kid, found, start)}
        return ends

    def one(kid, found, at):
        if kid[0] == html_text.GROUP:
            return run(kid[html_text.KIDS], found, at)
        if at < len(found):
            part = found[at]
            if isinstance(part, str):
                said = html_text._constant(html_text._squeezed(part))
                return {at + 1} if kid[0] == html_text.TEXT and kid[html_text.CONSTANT] in (None, said) else set()
            if part[0] == kid[0] and accepts(kid, part):
                return {at + 1}
        return set()

    def once(kid, found, at):
        ends = {at} if kid[html_text.OPTIONAL] else set()
        reached = one(kid, found, at)
        while reached:
            ends |= reached
            reached = {e for s in reached for e in one(kid, found, s)} - ends if kid[html_text.REPEATED] else set()
        return ends

    found = parts_of(tree)
    if part[html_text.ANY_ORDER]:
        ends = {0}
        while len(found) not in ends:
            more = ends | {e for s in ends for kid in part[html_text.KIDS] for e in one(kid, found, s)}
            if more == ends:
                return False
            ends = more
        return True
    return len(found) in run(part[html_text.KIDS], found, 0)


def test_a_wrapper_reads_every_page_it_was_made_of():
    import random

    pick = random.Random(11)

    def body(depth=0):
        out = []
        for _ in range(pick.randrange(5)):
            kind = pick.random()
            if kind < 0.4:
                out.append(pick.choice(["one ", "two ", "three "]))
            elif depth < 3:
                tag = pick.choice(["div", "p", "h2", "section"])
                out.append(f"<{tag}>{body(depth + 1)}</{tag}>" * pick.choice([1, 1, 2, 3]))
        return "".join(out)

    for _ in range(150):
        trees = [html_text.page_tree(f"<body>{body()}</body>") for _ in range(4)]
        made = None
        for tree in trees:
            own = html_text.page_wrapper(tree)
            assert accepts(own, tree)
            made = html_text._merged(made, own) if made else own
        assert all(accepts(made, tree) for tree in trees)


# --- licences ------------------------------------------------------------------


def test_license_cases(spark):
    mit = next(t.text for t in licenses.TEMPLATES if t.label == "mit" and not t.base)
    words = mit.split()
    changed = " ".join([*words[:9], "hereinafter", *words[9:]])
    rows = [
        (1, "The MIT License, and MIT-license again. Apache\nLICENSE", None),
        (1, "The MIT License, and MIT-license again. Apache\nLICENSE", None),
        (2, None, None),
        (3, "", None),
        (4, "mit", None),
        (5, "x " + changed + " y", None),
        (6, "gnu general public GNU GENERAL PUBLIC LICENSE", None),
        (None, "cc by nc", None),
        (8, LONG + "cc by", None),
        (9, "mİt license KC by", None),
    ]
    got = {r["doc_id"]: r for r in licenses.license_report(docs(spark, rows)).collect()}
    assert licenses.license_report(docs(spark, rows)).count() == len(rows)
    pick = lambda i: tuple(got[i])[1:7]
    assert pick(1) == (9, 3, 1, 7, "apache,mit", "apache,mit")
    assert pick(2) == pick(3) == (0, 0, None, None, "", "")
    assert pick(4) == (1, 0, None, None, "", "")
    assert pick(5)[1:] == (0, None, None, "", "mit") and 0.8 <= got[5]["score"] < 1
    assert pick(6) == (7, 1, 3, 3, "gpl", "gpl")
    assert pick(None)[4:] == ("cc-by", "cc-by,cc-by-nc")
    assert pick(8) == (108_002, 1, 108_000, 108_000, "cc-by", "cc-by")
    assert pick(9)[1] == 0
    assert licenses.license_report(docs(spark, [])).count() == 0


# --- lines -----------------------------------------------------------------------


def test_line_cases(spark):
    rows = [(i, f"Body {'abcdefgh'[i]} own words here\nShare on page {i} of 9 now please\nend {'abcdefgh'[i]} x y", "en") for i in range(8)]
    copies = [(20 + i, "Aaa the same text\nwith equal lines in it\nthree times over", "en") for i in range(9)]
    rows += [*copies, (40, None, None), (41, "", None), (42, "Share on page 77 of 9 now please\nShare on page 77 of 9 now please", None)]
    rows += [rows[0], (None, "Share on page 5 of 5 now please\nkept line of text", None)]
    table = docs(spark, rows)
    got = line_dedup.without_recurring_lines(table)
    assert got.columns == table.columns
    texts = {r["doc_id"]: r["text"] for r in got.collect()}
    assert got.count() == len(rows)
    assert texts[3] == "Body d own words here\nend d x y"
    assert texts[20] == copies[0][1]
    assert texts[40] is None and texts[41] == "" and texts[42] == ""
    assert texts[None] == "kept line of text"
    report = {r["doc_id"]: (r["n_lines"], r["n_dropped"]) for r in line_dedup.line_report(table).collect()}
    assert report[3] == (3, 1) and report[40] == (0, 0) and report[41] == (1, 0) and report[42] == (2, 2)
    assert line_dedup.line_report(docs(spark, [])).count() == 0


def unrelated(spark, line, n=100, first=0, end=""):
    """n documents of random words that share one line only."""
    import random

    pick = random.Random(first + 7)

    def sentence():
        return " ".join("".join(pick.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(pick.randrange(2, 9))) for _ in range(12))

    return [(first + i, f"{sentence()}\n{line}\n{sentence()}{end}", "en") for i in range(n)]


def lines_left(spark, rows):
    return {r["doc_id"]: r["text"].split("\n") for r in line_dedup.without_recurring_lines(docs(spark, rows)).collect()}


@pytest.mark.parametrize(
    "line",
    [
        "This line is on many pages of the web", "100 % of this line is on many pages", '"Zoom" is a line on many pages',
        "Copyright 2019 2020 Example", "Read more", "Call 1 800 555 1212 now", "more", "  spaced \t line ",
    ],
)
def test_a_line_in_unrelated_documents_goes(spark, line):
    left = lines_left(spark, unrelated(spark, line))
    assert all(len(lines) == 2 for lines in left.values())


def test_copies_of_a_page_cannot_keep_a_line_or_make_one_recur(spark):
    line = "This line is on many pages of the web"
    page = unrelated(spark, line, 1, 500)[0][1]
    words = page.split(" ")
    rows = unrelated(spark, line)
    # Exact copies, and copies with some words changed.
    rows += [(1000 + i, page, "en") for i in range(300)]
    rows += [(2000 + i, " ".join(f"changed{i}" if j in (i % 8, 20 + i % 5) else w for j, w in enumerate(words)), "en") for i in range(200)]
    left = lines_left(spark, rows)
    assert all(line not in lines for lines in left.values())
    assert all(len(lines) == 2 for lines in left.values())
    # Without the others the line is one of a page and its copies, and all of it stays.
    alone = lines_left(spark, rows[100:])
    assert all(len(lines) == 3 for lines in alone.values())


def test_columns_of_any_name_stay(spark):
    extra = "doc_id long, text string, _dropped string, _row_key string, _of_doc string, _id string, _key string, line string"
    rows = [(i, t, "d", "r", "o", "i", "k", "l") for i, t, _ in unrelated(spark, "shared by all of them", 8)]
    got = line_dedup.without_recurring_lines(spark.createDataFrame(rows, extra))
    assert got.columns == [c.split()[0] for c in extra.split(", ")]
    assert all(tuple(r)[2:] == ("d", "r", "o", "i", "k", "l") and "shared" not in r["text"] for r in got.collect())


# --- benchmark -------------------------------------------------------------------


def test_decontamination_cases(spark):
    ten = "a1 b2 c3 d4 e5 f6 g7 h8 i9 j10"
    items = [(1, ten + " k11"), (2, "Short ITEM"), (3, None), (4, ""), (2, "short item"), (None, "null id")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [
        (1, f"x {ten.upper()}! y", None),
        (2, "b2 c3 d4 e5 f6 g7 h8 i9 j10", None),
        (3, "a short-item, null id", None),
        (4, None, None),
        (5, LONG + ten + " k11", None),
        (1, f"x {ten.upper()}! y", None),
        (None, "short item", None),
    ]
    table = docs(spark, rows)
    for size in (500_000, 2):
        got = {r["doc_id"]: tuple(r)[1:4] + (r["contaminated"],) for r in decontaminate.contamination(table, bench, set_windows=size).collect()}
        assert got == {
            1: (12, 10, 1, True),
            2: (9, 0, 0, False),
            3: (5, 4, 2, True),
            4: (0, 0, 0, False),
            5: (108_011, 11, 1, True),
            None: (2, 2, 1, True),
        }
    clean = decontaminate.clean(table, bench)
    assert clean.columns == table.columns and sorted(r["doc_id"] for r in clean.collect()) == [2, 4]
    cut = {r["doc_id"]: r["text"] for r in decontaminate.clean(table, bench, remove="spans").collect()}
    assert cut[1] == "x ! y" and cut[3] == "a " and cut[4] is None
    assert decontaminate.contamination(docs(spark, []), bench).count() == 0
    assert decontaminate.clean(table, bench.limit(0)).count() == len(rows)


# --- language ----------------------------------------------------------------------


def test_language_cases(spark):
    german, english = "der schnelle Fuchs springt über den faulen Hund ", "the quick brown fox jumps over the lazy dog "
    rows = [(i, german * (1 + i % 3), "de") for i in range(40)] + [(100 + i, english * (1 + i % 3), "en") for i in range(50)]
    rows += [(200, None, "en"), (201, "", None), (202, "12 34 -- !", "de"), (203, LONG, None), (203, LONG, None)]
    table = docs(spark, rows)
    got = {r["doc_id"]: r for r in language.language_report(table).collect()}
    assert all(got[i]["lang_pred"] == "de" for i in range(40))
    assert all(got[100 + i]["lang_pred"] == "en" for i in range(50))
    for i in (200, 201, 202):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["rejected"]) == ("und", 0.0, True)
    assert got[203]["lang_pred"] == "en" and not got[203]["rejected"]
    kept = language.recognised(table)
    assert kept.columns == table.columns and kept.count() == len(rows) - 3
    unlabelled = docs(spark, [(1, "some words", None)])
    assert [r["lang_pred"] for r in language.language_report(unlabelled).collect()] == ["und"]
    assert language.language_report(docs(spark, [])).count() == 0


# --- quality -------------------------------------------------------------------------


def test_quality_cases(spark):
    def prose(i):
        return " ".join(f"word{chr(97 + i % 26)}{j}" for j in range(60))

    rows = [(i, prose(i), "en") for i in range(40)]
    rows += [
        (100, None, None),
        (101, "", "en"),
        (102, "a b c a b c d", "en"),
        (103, " ".join(f"{w}###$$$" for w in prose(3).split()), "en"),
        (104, prose(5), None),
        (105, "x x x x", None),
        (106, LONG, "en"),
        (0, prose(0), "en"),
    ]
    got = {r["doc_id"]: r for r in quality.judged(docs(spark, rows)).collect()}
    counts = lambda i: tuple(got[i][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
    assert counts(100) == counts(101) == (0, 0, 0, 0, 0)
    assert counts(102) == (7, 7, 0, 0, 6)
    assert counts(105) == (4, 4, 0, 0, 4)
    assert got[103]["n_symbols"] == 360 and not got[103]["base_failed"] and not got[103]["kept"]
    assert got[106]["base_failed"] and not got[106]["kept"]
    assert got[0]["kept"] and got[104]["kept"] and not got[100]["kept"]
    lines = docs(spark, [(1, "a b\n\na b\n \n a b\na b", "en")])
    assert quality.judged(lines).first()["n_dup_lines"] == 2
    assert quality.judged(docs(spark, [])).count() == 0
    assert quality.judged(docs(spark, rows)).count() == len(rows)


# --- URLs -------------------------------------------------------------------------------


def test_url_cases(spark):
    urls = [
        (1, "http://WWW.Example.com/en/x?q"),
        (2, "https://m.example.com/en/"),
        (3, "http://example.com"),
        (4, "http://a.b.net/fr/page"),
        (5, "http://net/es/"),
        (6, "http://notnet/es/"),
        (7, "http://x.org/en/"),
        (8, None),
        (9, "example.com/en/"),
        (10, "http://shop.com/#://net/es/"),
        (1, "http://WWW.Example.com/en/x?q"),
        (None, "ftp://ÄB.com:80/x"),
    ]
    table = spark.createDataFrame([(i, u, "h", "p") for i, u in urls], "page_id long, url string, host string, path string")
    rows = [tuple(r) for r in url_filter.judged_urls(table, url_filter.rule_table(spark)).collect()]
    assert len(rows) == len(urls)
    got = {r[0]: r[1:] for r in rows}
    assert got == {
        1: ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        2: ("m.example.com", "/en/", "example.com/en/", "block"),
        3: ("example.com", "", None, "allow"),
        4: ("a.b.net", "/fr/page", "net/fr/", "block"),
        5: ("net", "/es/", "net/es/", "block"),
        6: ("notnet", "/es/", None, "allow"),
        7: ("x.org", "/en/", None, "allow"),
        8: ("", "", None, "allow"),
        9: ("", "", None, "allow"),
        10: ("shop.com", "/", "com/", "allow"),
        None: ("Äb.com:80", "/x", None, "allow"),
    }
    own = url_filter.rule_table(spark, [("block", "com", "/a"), ("allow", "com", "/a"), ("allow", "com", "/abc")])
    verdicts = {
        r["path"]: r["verdict"]
        for r in url_filter.judged_urls(
            spark.createDataFrame([(1, "x://com/ab"), (2, "x://com/abcd"), (3, "x://com/b")], "page_id long, url string"), own, "none"
        ).collect()
    }
    assert verdicts == {"/ab": "block", "/abcd": "allow", "/b": "none"}
    assert url_filter.judged_urls(table.limit(0), own).count() == 0
    assert {r["verdict"] for r in url_filter.judged_urls(table, own.limit(0)).collect()} == {"allow"}


# --- packing ----------------------------------------------------------------------------


def test_piece_sizes_are_class_sizes():
    for capacity in (7, 64, 2048):
        for length in range(3 * capacity):
            sizes = packing.piece_sizes(length, capacity)
            assert sum(sizes) == length
            assert all(capacity // (capacity // s) == s for s in sizes)


def test_packing_cases(spark):
    from tests.llm.test_queries import check_packing

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = {1: None, 2: "", 3: "Don't  stop.\tI'LL go... x,y ÉTÉ <|endoftext|> J̌ a", 4: LONG, 5: "one"}
    table = docs(spark, [(i, t, None) for i, t in texts.items()])
    check_packing(packing.packed(table, path).collect(), texts)
    twice = packing.packed(docs(spark, [(5, "one", None)] * 3), path).collect()
    assert sorted((r["sequence_id"], r["offset"]) for r in twice)[0][1] == 0 and len(twice) == 3
    assert packing.packed(docs(spark, []), path).count() == 0


# --- chat ---------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, turns string"


def test_chat_cases(spark):
    rows = [
        (1, 0, "user", "a<|im_end|>\n"),
        (1, 1, "user", "<||im_sep|>|"),
        (1, 2, "assistant", "b<"),
        (1, 3, "assistant", "||c"),
        (2, None, None, None),
        (2, 5, "we|ird\n<|role|>", "x"),
        (None, 1, "assistant", ""),
        (3, 1, "user", "same"),
        (3, 1, "user", "same"),
        (4, 1, "assistant", LONG),
    ]
    table = spark.createDataFrame([(*r, "t") for r in rows], TURNS)
    made = chat.formatted(table)
    back = {r["conv_id"]: r for r in chat.read_back(made).collect()}
    turns = lambda i: [tuple(t) for t in back[i]["turns"]]
    assert turns(1) == [(r[2], r[3]) for r in rows[:4]]
    assert back[1]["loss"] == ["b<", "||c"]
    assert back[1]["formatted"].count("<|im_start|>") == 2
    assert turns(2) == [("", ""), ("we|ird\n<|role|>", "x")]
    assert turns(3) == [("user", "same")] * 2 and back[3]["loss"] == []
    assert turns(None) == [("assistant", "")] and back[None]["loss"] == [""]
    assert back[4]["loss"] == [LONG]
    assert chat.chat_report(table.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op2_licenses", "op3_line_dedup", "op6_quality", "op9_chat"])
def test_native_operators_run_no_python(spark, name):
    import contextlib
    import io

    from shopwright.llm.queries import QUERIES

    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        QUERIES[name](spark, "/root/testdata/sf0.001").explain("formatted")
    for word in ("Python", "Pandas", "MapInArrow", "Cartesian"):
        assert word not in text.getvalue()


def test_licences_of_any_length_are_found(spark):
    import random

    pick = random.Random(4)
    whole = [f"{pick.choice(['grant', 'notice', 'copy', 'source', 'form'])}{pick.randrange(300)}" for _ in range(2000)]
    known = [licenses.Template("long", " ".join(whole)), licenses.Template("half", " ".join(whole[:64]))]
    inserted = list(whole)
    for place in range(1900, 0, -400):
        inserted.insert(place, "hereinafter")
    rows = [
        (1, " ".join(whole), None), (2, "before it " + " ".join(inserted) + " after", None),
        (3, " ".join(whole[:1700]), None), (4, " ".join(whole[:1500]), None), (5, " ".join(reversed(whole)), None),
    ]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(docs(spark, rows), known).collect()}
    found = {i: [(s["label"], s["first_word"], s["end_word"]) for s in r["spans"]] for i, r in got.items()}
    assert found[1] == [("long", 0, 2000), ("half", 0, 64)]
    # Inserted words move the diagonal on by more than the slack in the end, which is merged step by step.
    assert [f[0] for f in found[2]] == ["long", "half"] and found[2][0][1:] == (2, 2007)
    assert [f[0] for f in found[3]] == ["long", "half"] and [f[0] for f in found[4]] == ["half"] and found[5] == []
    assert got[1]["best"] == 1.0 and abs(got[3]["best"] - 1.0) < 1e-9


# --- names, letters and collisions ------------------------------------------------


def test_columns_named_like_the_operators_own_stay(spark):
    kind = "doc_id long, text string, lang string, _hit_words string, _hit_spans string, _hit_items string, _id string, _margin string, _lang_pred string"
    rows = [(i, f"some english text number {i} with an item of ten words in all of it", "en", "w", "s", "i", "d", "m", "p") for i in range(4)]
    table = spark.createDataFrame(rows, kind)
    items = spark.createDataFrame([(1, "number 2 with an item of ten words in all")], "item_id long, text string")
    for got, n in ((decontaminate.clean(table, items), 3), (decontaminate.clean(table, items, remove="spans"), 4), (language.recognised(table), 4)):
        assert got.columns == table.columns
        kept = got.collect()
        assert len(kept) == n
        assert all(tuple(r)[3:] == ("w", "s", "i", "d", "m", "p") for r in kept)
    assert decontaminate.hits(table, items).columns == [*table.columns, "_hit_words_", "_hit_spans_", "_hit_items_"]


def test_a_null_item_is_not_the_item_called_null(spark):
    items = spark.createDataFrame([(None, "alpha beta"), ("null", "beta gamma"), ("a", "gamma")], "item_id string, text string")
    for most in (1, 500_000):
        row = decontaminate.contamination(docs(spark, [(1, "alpha beta gamma", None)]), items, set_windows=most).first()
        assert (row["n_hit"], row["n_items"]) == (3, 3)
        import hashlib

        assert row["items_sha256"] == hashlib.sha256(b"a,null,null").hexdigest()


def test_a_window_of_all_items_is_dealt_to_many_sets(spark):
    items = spark.createDataFrame([(i, f"the same prompt for all of them in every item here x{i}") for i in range(40)], "item_id long, text string")
    texts = docs(spark, [(1, "see the same prompt for all of them in every item here x7", None), (2, "no", None)])
    one = collected(decontaminate.contamination(texts, items))
    assert one == collected(decontaminate.contamination(texts, items, set_windows=3))
    assert [(r[2], r[3]) for r in one] == [(11, 40), (0, 0)] or [(r[2], r[3]) for r in one] == [(12, 40), (0, 0)]


def test_only_letters_make_a_text_tell_its_language(spark):
    rows = [(1, "ein text", "de"), (2, "a text", "en"), (3, "\u00b2 \u00bd \u2167 \u0661 12", None), (4, "\u4e00", None), (5, "\u00aa", None)]
    learned = language.learn(docs(spark, rows[:2]))
    got = {r["doc_id"]: r["_lang_pred"] for r in language.predict(docs(spark, rows), learned).collect()}
    assert got[3] == "und" and got[4] != "und" and got[5] != "und"


def test_equal_sizes_go_to_the_commoner_language(spark):
    rows = [(1, "same words here", "b"), (2, "same words here", "a"), (3, "same words here", "a"), (4, "same words here", "c")]
    learned = language.learn(docs(spark, rows))
    assert [r[0] for r in learned] == ["a", "b", "c"]
    assert {r["_lang_pred"] for r in language.predict(docs(spark, rows), learned).collect()} == {"a"}


def test_every_sampled_text_gives_a_piece_of_its_own_place(spark):
    long = " ".join(f"word{i}" for i in range(50_000))
    (lang, count, content), = language.learn(docs(spark, [(1, long, "en")]), dictionary_bytes=2000)
    assert (lang, count) == ("en", 1) and 900 <= len(content) <= 2000


def test_windows_that_share_hash_bits_are_told_apart(spark):
    text = "x b c q1 y b c q2 x b c".replace("x", "a1898839").replace("y", "a2725380")
    rows = [(1, text, "en"), (2, text.replace("q2", "q1"), "en"), (3, "p " * 40, "en")]
    got = {r["doc_id"]: r["n_repeat_words"] for r in quality.judged(docs(spark, rows)).collect()}
    # In the second "b c q1" comes twice, too.
    assert got == {1: 6, 2: 10, 3: 40}


def test_the_url_join_is_on_the_short_prefix_alone(spark):
    rows = spark.createDataFrame([(1, "http://www.example.com/en/x"), (2, "ftp://a.net/es/")], "page_id long, url string")
    got = url_filter.judged_urls(rows, url_filter.rule_table(spark))
    assert {(r["page_id"], r["rule"]) for r in got.collect()} == {(1, "www.example.com/en/"), (2, "net/es/")}
    joins = [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line]
    assert joins and all("suffix" not in j.split("]")[0] and "[substring(digest" in j or "[left(digest" in j for j in joins)


def test_ids_are_the_tokenizers_for_every_letter(spark):
    import sys
    import unicodedata
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    letters = [chr(c) for c in range(128, sys.maxunicode) if unicodedata.category(chr(c))[0] in "LM"]
    # Of scripts with thousands of letters that all behave alike, every fiftieth.
    letters = [c for i, c in enumerate(letters) if not ("\u3400" <= c <= "\ud7ff" or c >= "\U00010000") or i % 50 == 0]
    texts = [f"a {c}. b{c}, c{c}d) ,{c} {c}c! {c}=\u0338" for c in letters] + ["TAKS\u0130, gel DEN\u0130ZL\u0130.", "a\u0301, e=\u0338 x<\u0338"]
    encoder = packing.word_encoder(path)
    import pyarrow as pa

    ids, sizes = encoder(pa.array(texts))
    ends = np.append(0, np.cumsum(sizes))
    for text, lo, hi in zip(texts, ends, ends[1:]):
        assert ids[lo:hi].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
    assert zlib.crc32(ids.tobytes()) >= 0


def test_the_pipeline_takes_empty_tables_nulls_and_other_columns(spark, tmp_path):
    import corpus_pipeline

    benchmark = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id long, text string")
    kind = "doc_id long, text string, lang string, source string, n_chars long, _id string, node string, keys string, fold int"
    body = "the quick brown fox jumps over the lazy dog and runs away from the hunters in the wood "
    rows = [(i, f"{body * 3}{i} words of number {i}\nand then {i} some more", "en", "s", 1, "i", "n", "k", 3) for i in range(6)]
    rows += [(None, None, None, None, None, None, None, None, None), (7, "", "en", "s", 0, "i", "n", "k", 3), rows[0]]
    for name, data in (("empty", []), ("some", rows)):
        folder = str(tmp_path / name)
        spark.createDataFrame(data, kind).write.parquet(f"{folder}/documents.parquet")
        benchmark.write.parquet(f"{folder}/benchmark.parquet")
        got = corpus_pipeline.run(spark, folder)
        assert (got.count() > 0) == bool(data)
        table = spark.read.parquet(f"{folder}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            table = stage(spark, table, folder)
            assert table.columns == [c.split()[0] for c in kind.split(", ")]
