"""Lines that recur across documents, found with a log-template tree.

A line's tokens lie between white space; tokens with a digit are fields. Its leaf in
the tree is its number of tokens and its first ``depth`` tokens. Inside a leaf a
token at a place is fixed when at least ``min_docs`` texts have it there, and a
field otherwise. Fixed tokens and leaf make the template of a line of ``min_tokens`` tokens or
more, if at least the share ``fixed`` of them is fixed. Besides, every wording is a template of its own, of any length
and with any digits. A template that recurs in at least ``min_docs`` unrelated documents is dropped from all.

Copies of one text must not make its lines recurring; they are left to near-duplicate
removal. What a line's documents have in common is judged by the rest of their texts, which the line cannot
decide: chunks of a few words are taken from the other lines, and the ``MARKS`` chunks whose MD5 is smallest
are the document's marks for this line. Documents that share ``SHARED`` marks are related. A document counts as one part in as
many as share its third commonest mark under the template (its rarest, if it has fewer), so copies and
edited copies count about once, however many there are, and take nothing from the count of others. Documents of nothing but
the template are related too.

All counting is by hashes on narrow rows, pre-aggregated before each shuffle. Tokens
are only spread out for lines whose leaf occurs often enough to hold a template, one line of each
wording, and marks only for templates in enough texts. Tables that the later joins read are stored. Those whose counted size is under a
bound are broadcast, which spares a shuffle of all texts; beyond it the join shuffles, and
Spark splits hot keys.

Defined cases: null texts stay null and have no lines; lines without a token are kept and
not counted. Repeated rows are copies of one document:
they get the same result and do not count twice. Null ids are ids. Other columns stay as
they are (``without_recurring_lines``) or are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopwright.llm.expr import SPACE_BREAK, broadcast_if_small, filled, unused, words_of
from shopwright.shared import stored

DEPTH = 3
MIN_DOCS = 5
MIN_TOKENS = 3
FIXED = 0.75
MARKS = 8
SHARED = 3
# A chunk ends after a word that ends in one of these letters; chunks of one word are too common to tell.
# In a text of LONG characters or more it is the three words after one of these rarer endings, of which there are enough.
CHUNK, RARE, LONG = "([an-z]) ", "([aeou][rst]) ", 2000
FIELD = "<*>"
_WHOLE = 10**12


def _masked(token: Column) -> Column:
    return F.when(token.rlike("[0-9]"), F.lit(FIELD)).otherwise(token)


def _row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def _chunks(line: Column, long: Column) -> Column:
    """The smallest MD5 sums of a line's chunks of several words."""
    rare = F.split(F.regexp_replace(line, RARE, "$1\n"), "\n")
    parts = F.when(long, F.transform(rare, lambda part: F.substring_index(part, " ", 3))).otherwise(
        F.split(F.regexp_replace(line, CHUNK, "$1\n"), "\n")
    )
    told = F.filter(parts, lambda part: F.contains(part, F.lit(" ")))
    return F.slice(F.array_distinct(F.sort_array(F.transform(told, lambda part: F.md5(part)))), 1, MARKS)


def numbered_lines(docs: DataFrame, depth: int, min_tokens: int) -> DataFrame:
    """row_key, doc_id, text_key, pos, line (a hash), leaf (null for lines of fewer than min_tokens) and marks of all lines with a token."""
    each = F.transform(
        F.split(filled(F.col("text")), "\n"),
        lambda line: F.struct(
            F.xxhash64(line).alias("line"), words_of(line, SPACE_BREAK).alias("tokens"), F.md5(line).alias("key"), line.alias("text")
        ),
    )
    split = docs.select(_row_key().alias("row_key"), "doc_id", F.xxhash64("text").alias("text_key"), (F.length("text") >= LONG).alias("long"), each.alias("lines"))
    worded = F.array_distinct(
        F.transform(
            F.filter("lines", lambda line: F.size(line["tokens"]) > 0),
            lambda line: F.named_struct(F.lit("key"), line["key"], F.lit("chunks"), _chunks(line["text"], F.col("long"))),
        )
    )
    found = F.flatten(
        F.transform(worded, lambda line: F.transform(line["chunks"], lambda c: F.named_struct(F.lit("mark"), c, F.lit("key"), line["key"])))
    )
    # One line has at most MARKS of them, so these hold the first MARKS of all other lines.
    first = F.slice(F.array_sort(found), 1, 2 * MARKS)
    # Computed below the explosion, once for a text.
    spread = split.withColumn("first", first).select("row_key", "doc_id", "text_key", "first", F.posexplode("lines").alias("pos", "of"))
    tokens, key = F.col("of.tokens"), F.col("of.key")
    others = F.slice(F.filter("first", lambda chunk: chunk["key"] != key), 1, MARKS)
    marks = F.array_distinct(F.transform(others, lambda chunk: F.xxhash64(chunk["mark"])))
    leaf = F.xxhash64(F.size(tokens), *(_masked(F.get(tokens, F.lit(i))) for i in range(depth)))
    return spread.filter(F.size(tokens) > 0).select(
        "row_key", "doc_id", "text_key", "pos", F.col("of.line").alias("line"),
        F.when(F.size(tokens) >= min_tokens, leaf).alias("leaf"), marks.alias("marks"),
    )


def _templates(docs: DataFrame, wordings: DataFrame, min_docs: int, fixed: float) -> DataFrame:
    """line, template (hashes) of all wordings whose generalised template is in at least min_docs texts."""
    long_enough = wordings.filter("leaf is not null")
    leaves = long_enough.groupBy("leaf").agg(F.sum("texts").alias("all")).filter(F.col("all") >= min_docs).select("leaf")
    chosen = stored(long_enough.join(stored(leaves, "leaves"), "leaf"), "chosen")

    # One text of each chosen wording. Only lines of chosen leaves meet their text again.
    texts = docs.select(F.explode(F.split(filled(F.col("text")), "\n")).alias("text"))
    texts = texts.select("text", F.xxhash64("text").alias("line"))
    wanted = broadcast_if_small(chosen.select("line"))
    worded = texts.join(wanted, "line", "left_semi").groupBy("line").agg(F.min("text").alias("text"))
    keys = ["line", "leaf", "texts"]
    tokens = (
        worded.join(chosen, "line")
        .select(*keys, words_of(F.col("text"), SPACE_BREAK).alias("tokens"))
        .select(*keys, F.size("tokens").alias("size"), F.posexplode("tokens").alias("at", "token"))
        .filter(~F.col("token").rlike("[0-9]"))
        .select(*keys, "size", "at", F.xxhash64("token").alias("token"))
    )
    tokens = stored(tokens, "tokens")
    common = tokens.groupBy("leaf", "at", "token").agg(F.sum("texts").alias("all")).filter(F.col("all") >= min_docs)
    common = stored(common.drop("all"), "common")
    templates = (
        tokens.join(common, ["leaf", "at", "token"])
        .groupBy(*keys, "size")
        .agg(F.count("*").alias("fixed"), F.bit_xor(F.xxhash64("at", "token")).alias("shape"))
        .filter(F.col("fixed") >= F.lit(fixed) * F.col("size"))
        .select("line", "texts", F.xxhash64("leaf", "fixed", "shape").alias("template"))
    )
    templates = stored(templates, "templates")
    often = templates.groupBy("template").agg(F.sum("texts").alias("all")).filter(F.col("all") >= min_docs)
    return templates.join(stored(often.select("template"), "often"), "template").select("line", "template")


def recurring_lines(docs: DataFrame, lines: DataFrame, min_docs: int = MIN_DOCS, fixed: float = FIXED) -> DataFrame:
    """line (a hash) of all lines whose wording or template recurs; ``lines`` is stored."""
    wordings = stored(
        lines.groupBy("line", "text_key")
        .agg(F.first("leaf").alias("leaf"))
        .groupBy("line")
        .agg(F.first("leaf").alias("leaf"), F.count("*").alias("texts")),
        "wordings",
    )
    exact = wordings.filter(F.col("texts") >= min_docs).select("line", F.col("line").alias("template"), F.lit(True).alias("exact"))
    general = _templates(docs, wordings, min_docs, fixed).withColumn("exact", F.lit(False))
    suspects = stored(exact.unionByName(general), "suspects")

    template = ["exact", "template"]
    met = lines.join(broadcast_if_small(suspects), "line")
    # A text may have lines of one template with different marks; -1 stands for the lack of any.
    marks = met.select(*template, "text_key", F.explode(F.when(F.size("marks") == 0, F.array(F.lit(-1).cast("long"))).otherwise(F.col("marks"))).alias("mark"))
    marks = stored(marks.distinct(), "marks")
    shared = stored(marks.groupBy(*template, "mark").agg(F.count("*").alias("sharing")), "sharing")
    third = F.element_at(F.sort_array(F.collect_list("sharing"), asc=False), F.least(F.lit(SHARED), F.count("*")).cast("int"))
    parts = marks.join(shared, [*template, "mark"]).groupBy(*template, "text_key").agg(third.alias("sharing"))
    part = F.expr(f"({_WHOLE} + sharing - 1) div sharing").cast("decimal(18,0)")
    often = parts.groupBy(*template).agg(F.sum(part).alias("all")).filter(F.col("all") >= _WHOLE * min_docs)
    often = stored(often.select(*template), "often")
    return stored(suspects.join(often, template).select("line").distinct(), "recurring")


def marked(
    docs: DataFrame, dropped: str, depth: int = DEPTH, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, fixed: float = FIXED
) -> DataFrame:
    """docs with the column ``dropped``: the sorted places of their recurring lines, from 0, null without any."""
    own = docs.select("doc_id", "text")
    lines = stored(numbered_lines(own, depth, min_tokens), "lines")
    recurring = recurring_lines(own, lines, min_docs, fixed)
    key, of = (unused(name, [*docs.columns, dropped]) for name in ("_row_key", "_of_doc"))
    places = (
        lines.join(broadcast_if_small(recurring), "line")
        .groupBy("row_key", "doc_id")
        # Repeated rows name the same places.
        .agg(F.sort_array(F.collect_set("pos")).alias("places"))
    )
    places = broadcast_if_small(stored(places, "places"), F.size("places")).select(
        F.col("row_key").alias(key), F.col("doc_id").alias(of), F.col("places").alias(dropped)
    )
    same = (_row_key() == F.col(key)) & docs["doc_id"].eqNullSafe(F.col(of))
    return docs.join(places, same, "left").drop(key, of)


def _kept_text(dropped: str) -> Column:
    kept = F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains(dropped, i))
    return F.when(F.col(dropped).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))


def line_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, text (what is left)."""
    return marked(docs.select("doc_id", "text"), "dropped").select(
        "doc_id",
        F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        _kept_text("dropped").alias("text"),
    )


def without_recurring_lines(docs: DataFrame) -> DataFrame:
    """The documents in the columns they came with, recurring lines taken out of text."""
    dropped = unused("_dropped", docs.columns)
    found = marked(docs, dropped)
    return found.withColumn("text", _kept_text(dropped)).select(*(f"`{c}`" for c in docs.columns))
