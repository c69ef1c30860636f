"""Main text of web pages by union-free wrappers.

The pages of a host share a layout. Each page's token stream of tags and texts is
read as nested elements; streams of one host are aligned one after the other, and the
expression that describes all of them, the wrapper, grows with each. A wrapper is
union-free: where two streams differ, the element that only one of them has becomes
optional, equal neighbours (and equal runs of neighbours) become a repeated group, and
texts that differ anywhere become a slot.

Every page is read along its host's wrapper. A text that the wrapper has as a constant, on at least
``TEMPLATE_PAGES`` pages and more than half of the host's, is part of the template; the others stand in slots.
The article is made of slots and its headings: of the elements marked as article, else as main part, else named as
content, else the element whose own paragraphs have most text in slots, with its like neighbours. From it goes what tags,
roles and names mark as menus, headers, footers, sidebars, notices, adverts, forms and comments. Names are judged strictly inside
an article: a whole word of a class or id, or a compound of nothing but such words ("share-buttons", not "market-share").
A page whose article has constants only, such as one of many copies, keeps them.

Wrappers of parts of a host's pages are made where the pages are read and are merged in
two rounds, first by host and salt; no task sees all pages of a host. An element with more than
``MAX_KIDS`` different parts takes its parts in any order from then on, each optional and repeated, and
what lies deeper than ``WRAPPER_DEPTH`` elements belongs to the wrapper's element above it; a run of equal neighbours is
looked for up to ``LONGEST_UNIT`` elements long. These bound the work on a wrapper; pages are read
to any depth and length, and no text is lost by them.

Defined cases: null html or url count as empty; pages without a host belong to
no common site and are each read alone. A page whose marked elements are all empty has an empty text. Broken
markup is read as far as it goes, open elements end with the page. Repeated
rows are each reported. Columns other than page_id, url and html are ignored.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
import sys
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopwright.llm.expr import filled
from shopwright.shared import stored

MAX_KIDS = 48
WRAPPER_DEPTH = 1000
LONGEST_UNIT = 6
TEMPLATE_PAGES = 3
SALTS = 64

# Elements by their meaning in HTML, and words in names and roles.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr "
    "math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace "
    "msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
DROPPED = frozenset(
    "annotation aside audio button canvas datalist dialog fieldset footer form frame frameset head iframe input label legend "
    "map menu nav noscript object optgroup option picture progress script select style svg template textarea "
    "title video".split()
)
OUTER = frozenset(["header", "hgroup"])
NAMED = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies discussion disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices overlay "
    "pager pagination popup promo promoted promotion recommended related replies reply respond search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget widgets alert alerts".split()
)
OUTER_NAMED = frozenset("header topbar".split())
# Words that say nothing on their own, in a compound name.
FILLING = frozenset(
    "a and area bar bars block bottom box btn button buttons container count element feed for form group head header "
    "holder icon icons inner item items large layer left link links list main module nav of on outer page pane panel "
    "post posts region right row section site slot small text thread title tools top unit us wrap wrapper".split()
)
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split()
)
MAIN = ("article", "main")
MAIN_NAMED = frozenset("article content entry main post story".split())
CLOSED_BY = {
    "li": ("li", ("ul", "ol", "menu")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table", "tbody", "thead", "tfoot")),
    "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")),
    "option": ("option", ("select", "datalist")),
}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|svg|iframe)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-z][^>]*\Z",
    re.S | re.I,
)
_ATTR = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_NAME = re.compile(r"[^\W\d_]+")

# A part of a wrapper, as a list that turns into JSON: element key, or TEXT or GROUP.
TEXT, GROUP = "#", "()"
KEY, OPTIONAL, REPEATED, ANY_ORDER, PAGES, CONSTANT, CHARS, KIDS = range(8)


def _strictly(name: str) -> bool:
    """Whether a class or id as a whole names what is never content."""
    words = _NAME.findall(name)
    return any(w in NAMED for w in words) and all(w in NAMED or w in FILLING for w in words)


def _key(tag: str, attrs: str) -> str:
    """tag, a space, the sorted words of its class and id; in front "!" if it is never content, "~" if only outside an article."""
    names: set[str] = set()
    hidden = strict = False
    if attrs:
        for name, *values in _ATTR.findall(attrs):
            name, value = name.lower(), "".join(values).lower()
            if name in ("class", "id"):
                names.update(_NAME.findall(value))
                strict = strict or any(map(_strictly, value.split()))
            elif name == "role":
                names.update(f"role-{r}" for r in value.split())
            elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                hidden = True
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                hidden = True
    if tag in ("html", "body"):
        return tag
    out = tag in DROPPED or hidden or any(f"role-{r}" in names for r in ROLES)
    if tag in MAIN:
        out = out or "comment" in names or "comments" in names
        mark = "!" if out else ""
    else:
        mark = "!" if out or strict else "~" if names & NAMED else ""
    return f"{mark}{tag} {' '.join(sorted(names))}".rstrip()


def page_tree(page: str) -> list:
    """Nested [key, parts]; a part is such an element or a string of text."""
    root: list = ["", []]
    stack: list[tuple[str, list]] = [("", root)]
    opened: Counter = Counter()

    def text(raw: str) -> None:
        parts = stack[-1][1][1]
        if parts and isinstance(parts[-1], str):
            parts[-1] += raw
        else:
            parts.append(raw)

    def close(tags: tuple[str, ...], within: tuple[str, ...]) -> None:
        if not any(opened[t] for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                opened.subtract(name for name, _ in stack[i:])
                del stack[i:]
                return
            if stack[i][0] in within:
                return

    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            text(html.unescape(page[at : token.start()]))
        at = token.end()
        tag = (token["tag"] or "").lower()
        if not tag:
            continue
        attrs = token["attrs"]
        if token["end"]:
            close((tag,), ())
            continue
        if tag == "br":
            text(" ")
            continue
        key = _key(tag, attrs)
        if tag in VOID or (tag in INLINE and key[0] != "!"):
            if tag == "hr":
                stack[-1][1][1].append(["hr", []])
            continue
        if tag not in INLINE:
            close(("p",), ("article", "body", "div", "li", "main", "section", "td"))
        if tag in CLOSED_BY:
            ended, within = CLOSED_BY[tag]
            for _ in ended.split():
                close(tuple(ended.split()), within)
        element: list = [key, []]
        stack[-1][1][1].append(element)
        if not attrs.endswith("/"):
            stack.append((tag, element))
            opened[tag] += 1
    if at < len(page):
        text(html.unescape(page[at:]))
    return root


def _squeezed(text: str) -> str:
    return " ".join(text.split())


def _constant(said: str) -> str:
    """What stands for a text in a wrapper: equal only for equal texts, and short."""
    return said if len(said) <= 64 else f"{said[:31]} {hashlib.blake2b(said.encode('utf-8', 'surrogatepass'), digest_size=16).hexdigest()}"


def _texts_below(tree: list) -> list[str]:
    """All texts of an element, in order."""
    out, todo = [], [tree]
    while todo:
        here = todo.pop()
        if isinstance(here, str):
            out.append(here)
        else:
            todo += reversed(here[1])
    return out


def page_wrapper(tree: list, depth: int = 0) -> list:
    """The wrapper of one page."""
    kids = []
    for part in tree[1] if depth < WRAPPER_DEPTH else _texts_below(tree):
        if isinstance(part, str):
            said = _squeezed(part)
            if said:
                kids.append([TEXT, 0, 0, 0, 1, _constant(said), len(said), []])
        else:
            kids.append(page_wrapper(part, depth + 1))
    return _bounded([tree[0], 0, 0, 0, 1, None, 0, _folded(kids)])


def _bounded(part: list) -> list:
    """From MAX_KIDS different parts on, an element's parts stand in any order."""
    if part[ANY_ORDER] or len(part[KIDS]) > MAX_KIDS:
        part[ANY_ORDER] = 1
        by_shape: dict[str, list] = {}
        for kid in _ungrouped(part[KIDS]):
            known = by_shape.get(kid[KEY])
            by_shape[kid[KEY]] = kid = _merged(known, kid) if known else kid
            kid[OPTIONAL] = kid[REPEATED] = 1
        part[KIDS] = [by_shape[shape] for shape in sorted(by_shape)]
    return part


def _ungrouped(kids: list) -> list:
    return [k for kid in kids for k in (_ungrouped(kid[KIDS]) if kid[KEY] == GROUP else [kid])]


def _shape(part: list) -> str:
    return part[KEY] if part[KEY] != GROUP else GROUP + ",".join(map(_shape, part[KIDS])) + ")"


def _folded(kids: list) -> list:
    """Equal neighbours, and then equal runs of neighbours, as one repeated part."""
    for unit in range(1, LONGEST_UNIT + 1):
        out: list = []
        shapes: list[str] = []
        i, names = 0, [_shape(k) for k in kids]
        while i < len(kids):
            run = names[i : i + unit]
            if len(run) == unit and i + 2 * unit <= len(kids) and names[i + unit : i + 2 * unit] == run and TEXT not in run[:1]:
                same = kids[i : i + unit]
                i += unit
                while names[i : i + unit] == run:
                    same = [_merged(a, b) for a, b in zip(same, kids[i : i + unit])]
                    i += unit
                if unit == 1:
                    same[0][REPEATED] = 1
                    out += same
                else:
                    out.append([GROUP, 0, 1, 0, max(s[PAGES] for s in same), None, 0, same])
            else:
                out.append(kids[i])
                i += 1
        kids = out
    return kids


def _aligned(a: list, b: list) -> list:
    """Parts of both sequences in order; parts of one alone become optional."""
    x, y = [_shape(k) for k in a], [_shape(k) for k in b]
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if x[i] == y[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(x) or j < len(y):
        if i < len(x) and j < len(y) and x[i] == y[j]:
            out.append(_merged(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == len(y) or (i < len(x) and best[i + 1][j] >= best[i][j + 1]):
            a[i][OPTIONAL] = 1
            out.append(a[i])
            i += 1
        else:
            b[j][OPTIONAL] = 1
            out.append(b[j])
            j += 1
    return out


def _unrolled(kids: list, other: list) -> list:
    """kids with a run that the other side has as a repeated group written as that group."""
    groups = {tuple(map(_shape, k[KIDS])) for k in other if k[KEY] == GROUP}
    for unit in groups:
        names = [_shape(k) for k in kids]
        for i in range(len(names) - len(unit) + 1):
            if tuple(names[i : i + len(unit)]) == unit:
                kids = [*kids[:i], [GROUP, 0, 0, 0, 1, None, 0, kids[i : i + len(unit)]], *kids[i + len(unit) :]]
                break
    return kids


def _merged(a: list, b: list) -> list:
    """The wrapper of everything that a or b describes; both have one key."""
    for n in (OPTIONAL, REPEATED, ANY_ORDER):
        a[n] |= b[n]
    a[PAGES] += b[PAGES]
    a[CHARS] += b[CHARS]
    if a[CONSTANT] != b[CONSTANT]:
        a[CONSTANT] = None
    if a[ANY_ORDER]:
        a[KIDS] = a[KIDS] + b[KIDS]
    elif a[KEY] != TEXT:
        a[KIDS] = _folded(_aligned(_unrolled(a[KIDS], b[KIDS]), _unrolled(b[KIDS], a[KIDS])))
    return _bounded(a)


def expression(part: list) -> str:
    """A wrapper as a regular expression over tags and texts, for reading."""
    if part[KEY] == TEXT:
        body = "TEXT" if part[CONSTANT] is None else repr(part[CONSTANT])
    else:
        body = (" | " if part[ANY_ORDER] else " ").join(map(expression, part[KIDS]))
        if part[ANY_ORDER]:
            body = f"( {body} )*"
        if part[KEY] not in ("", GROUP):
            body = f"<{part[KEY]}> {body} </>"
    if part[REPEATED]:
        return f"( {body} )+" + "?" * part[OPTIONAL]
    return f"( {body} )?" if part[OPTIONAL] else body


def _is_main(key: str) -> bool:
    tag, *names = key.lstrip("!~").split()
    return tag in MAIN or "role-main" in names or "role-article" in names


def _dropped(key: str, inside: bool) -> bool:
    """Never content; headers and doubtful names only count as the page's outside the article."""
    if key.startswith("!"):
        return True
    if inside or not key:
        return False
    tag, *names = key.split()
    return (key[0] == "~" or tag in OUTER or bool(OUTER_NAMED & set(names))) and not _is_main(key)


def _is_content(key: str) -> bool:
    return bool(MAIN_NAMED & set(key.split()[1:]))


# What marks the article, best first.
MARKS = (lambda key: key.split()[0] == "article", _is_main, _is_content)
PARAGRAPHS = ("p", "pre", "blockquote")
HEADINGS = [[f"h{i}"] for i in range(1, 7)]


def _marked(tree: list, test) -> list[list]:
    """The outermost elements of a page that pass the test, outside what is never content."""
    found, todo = [], [tree]
    while todo:
        here = todo.pop()
        if here[0].startswith("!") or (test is _is_content and _dropped(here[0], False)):
            continue
        if here[0] and test(here[0]):
            found.append(here)
        else:
            todo += [part for part in reversed(here[1]) if not isinstance(part, str)]
    return found


def _template_texts(tree: list, wrapper: list | None) -> dict[int, set[str]]:
    """Constants of the wrapper by the element (its id) they stand in, walking a page along the wrapper."""
    if wrapper is None:
        return {}
    least = max(TEMPLATE_PAGES, wrapper[PAGES] // 2 + 1)
    out: dict[int, set[str]] = {}
    todo = [(tree, [wrapper])]
    while todo:
        element, parts = todo.pop()
        kids = [kid for part in parts for kid in _ungrouped(part[KIDS])]
        constants = {k[CONSTANT] for k in kids if k[KEY] == TEXT and k[CONSTANT] is not None and k[PAGES] >= least}
        if constants:
            out[id(element)] = constants
        by_key: dict[str, list[list]] = {}
        for kid in kids:
            if kid[KEY] != TEXT:
                by_key.setdefault(kid[KEY], []).append(kid)
        inner: dict[str, list[list]] = {}
        for part in element[1]:
            if not isinstance(part, str) and part[0] in by_key:
                inner.setdefault(part[0], []).append(part)
        for key, found in inner.items():
            same = by_key[key]
            if len(found) == len(same) and not any(p[REPEATED] for p in same):
                todo += [(one, [part]) for one, part in zip(found, same)]
            else:
                # Which part an element stands for is open, so it may be any of them.
                todo += [(one, same) for one in found]
    return out


def _slot_text(element: list, part: str, template: dict[int, set[str]]) -> str:
    """The text of a slot, or nothing for a constant; a heading belongs to its article even if others have the same."""
    said = _squeezed(part)
    known = None if element[0].split()[:1] in HEADINGS else template.get(id(element))
    return "" if known and said and _constant(said) in known else said


def _densest(tree: list, template: dict[int, set[str]]) -> list | None:
    """The element whose own paragraphs have most text in slots; if a neighbour of the same key has such text, the one around both."""
    order, parent, todo = [], {}, [tree]
    while todo:
        here = todo.pop()
        order.append(here)
        for part in reversed(here[1]):
            if not isinstance(part, str) and not _dropped(part[0], False):
                parent[id(part)] = here
                todo.append(part)
    below: dict[int, int] = {}
    own: dict[int, int] = {}
    for here in reversed(order):
        total = direct = 0
        for part in here[1]:
            if isinstance(part, str):
                size = len(_slot_text(here, part, template))
                direct += size
            else:
                size = below.get(id(part), 0)
                direct += size if part[0].split()[0].lstrip("~") in PARAGRAPHS else 0
            total += size
        below[id(here)], own[id(here)] = total, direct
    best = None
    for here in order:
        if here[0].split()[:1] not in ([p] for p in PARAGRAPHS) and own[id(here)] > (own[id(best)] if best else 0):
            best = here
    while best is not None and id(best) in parent:
        around = parent[id(best)]
        if not any(p is not best and p[0] == best[0] and below.get(id(p)) for p in around[1] if not isinstance(p, str)):
            break
        best = around
    return best


def _blocks(tree: list, template: dict[int, set[str]], out: list[str], inside: bool = True) -> None:
    """Texts of an element inside the article, a block for each run of text."""
    todo: list[tuple[list, list | str]] = [(tree, part) for part in reversed(tree[1])]
    while todo:
        here, part = todo.pop()
        if isinstance(part, str):
            said = _slot_text(here, part, template)
            if said:
                out.append(said)
        elif not _dropped(part[0], inside):
            todo += [(part, inner) for inner in reversed(part[1])]


def page_text(page: str, wrapper: list | None) -> str:
    """The text of a page by the wrapper of its host, if it has one."""
    tree = page_tree(page)
    found = _template_texts(tree, wrapper)
    # A page of constants alone is read as it is.
    for template in [found, {}] if found else [{}]:
        out: list[str] = []
        named = False
        for test in MARKS:
            mains = _marked(tree, test)
            named |= bool(mains)
            for main in mains:
                _blocks(main, template, out)
            if out:
                return "\n".join(out)
        densest = None if named else _densest(tree, template)
        if densest is not None:
            _blocks(densest, template, out, densest[0] not in ("", "html", "body"))
            return "\n".join(out)
    return ""


def _deep() -> None:
    """Room for wrappers as deep as WRAPPER_DEPTH."""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 20 * WRAPPER_DEPTH))


def _with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(filled(F.col("url")), r"(?s)^.*?://([^/?#]*)", 1))
    return pages.select("page_id", "url", filled(F.col("html")).alias("html"), host.alias("host"))


def host_wrappers(pages: DataFrame) -> DataFrame:
    """host, wrapper (JSON) from all pages that have a host."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _deep()
        for batch in batches:
            made: dict[str, list] = {}
            seen: set[tuple[str, int]] = set()
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # Copies say nothing of what varies.
                if (host, hash(page)) in seen:
                    continue
                seen.add((host, hash(page)))
                own = page_wrapper(page_tree(page))
                key = host
                made[key] = _merged(made[key], own) if key in made else own
            yield pa.record_batch(
                [pa.array(list(made), pa.string()), pa.array([json.dumps(w) for w in made.values()], pa.string())],
                names=["host", "wrapper"],
            )

    def together(part: pd.DataFrame) -> pd.DataFrame:
        _deep()
        # Sorted, so that the result does not depend on the order of arrival.
        texts = sorted(part["wrapper"])
        wrapper = json.loads(texts[0])
        for text in texts[1:]:
            wrapper = _merged(wrapper, json.loads(text))
        return pd.DataFrame({"host": [part["host"].iloc[0]], "wrapper": [json.dumps(wrapper)]})

    hosted = _with_host(pages).filter(F.col("host") != "").select("host", "html")
    parts = hosted.mapInArrow(local, "host string, wrapper string")
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    kind = "host string, wrapper string"
    return salted.groupBy("host", "salt").applyInPandas(together, kind).groupBy("host").applyInPandas(together, kind)


def main_texts(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text."""
    wrappers = stored(host_wrappers(pages), "wrappers").withColumnRenamed("host", "of_host")
    paged = _with_host(pages)
    joined = paged.join(wrappers, paged["host"] == wrappers["of_host"], "left").select("page_id", "url", "html", "wrapper")

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _deep()
        for batch in batches:
            known: dict[str | None, list | None] = {None: None}
            texts = []
            for page, wrapper in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if wrapper not in known:
                    known[wrapper] = json.loads(wrapper)
                texts.append(page_text(page, known[wrapper]))
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    page_id = pages.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(extracted, f"page_id {page_id}, url string, text string")


def page_report(pages: DataFrame) -> DataFrame:
    return main_texts(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
