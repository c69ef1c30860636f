"""Quality rules whose thresholds follow the data.

Per document: counts over its whole text. Per language and source: a quantile
sketch of each ratio, merged upwards into one per language and one for all
rows. A group's fence is its upper quartile plus ``spread`` times the distance of
its quartiles, which is taken as at least a stated floor; where a group has
fewer than ``least`` documents its language decides, and then all rows. Documents
outside a fence are not kept. Sketches are merged from partial ones, so a source
with a third of all rows is no single task, and a sketch over fewer than ``SKETCH_K``
values is exact.

Counts are stored before the sketches and the filter read them, so texts are
scanned once. Thresholds are one row per language and source; Spark broadcasts
them where their stored size allows and else splits a hot source.

Defined cases: null and empty texts have no words and fail the base rule. Null
languages and sources are groups of their own. A document exactly on a fence is
kept. Repeated rows are each judged. Other columns than doc_id, text, lang and
source are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopwright.llm.expr import SPACE_BREAK, filled, words_of
from shopwright.shared import stored

SKETCH_K = 4096
SPREAD = 3.0
LEAST = 30
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# The least distance between quartiles that a fence assumes, by ratio.
FLOORS = {"symbol_share": 0.02, "dup_line_share": 0.1, "repeat_share": 0.1, "word_length": 0.5}
_PLACE_BITS = 24


def _mask() -> Column:
    return F.lit((1 << _PLACE_BITS) - 1).cast("long")


def _same_hash(x: Column, y: Column) -> Column:
    return F.shiftright(x, _PLACE_BITS) == F.shiftright(y, _PLACE_BITS)


def _same_words(x: Column, y: Column) -> Column:
    """Whether the windows at two packed places have equal words."""
    i, j = x.bitwiseAND(_mask()).cast("int"), y.bitwiseAND(_mask()).cast("int")
    equal = F.lit(True)
    for n in range(3):
        equal = equal & (F.get("words", i + n) == F.get("words", j + n))
    return equal


def _beside(values: str, same: Callable[[Column, Column], Column]) -> Column:
    """The values that are the same as a neighbour."""

    def known(x: Column, y: Column) -> Column:
        return F.coalesce(same(x, y), F.lit(False))

    return F.filter(values, lambda x, i: known(x, F.get(values, i + 1)) | known(x, F.get(values, i - 1)))


def _ambiguous() -> Column:
    """Whether ``sorted`` can't tell equal windows: different neighbours share the bits, or places have too few."""
    next_one = lambda x, i: _same_hash(x, F.get("sorted", i + 1)) & ~_same_words(x, F.get("sorted", i + 1))
    differing = F.filter("sorted", lambda x, i: F.coalesce(next_one(x, i), F.lit(False)))
    return (F.size(differing) > 0) | (F.size("words") >= 1 << _PLACE_BITS)


def _windows_by_words() -> Column:
    """Every three-word window with its place, sorted by its words."""
    window = lambda word, i: F.named_struct(
        F.lit("three"), F.array(word, F.get("words", i + 1), F.get("words", i + 2)), F.lit("at"), i.cast("long")
    )
    return F.array_sort(F.slice(F.transform("words", window), 1, F.greatest(F.size("words") - 2, F.lit(0))))


def _repeated_places() -> Column:
    """Places of the three-word windows of column ``words`` that occur twice or more, in order.

    ``sorted`` has one number per window: high bits of its hash, then its place. Equal windows are neighbours
    there, and their words are compared. A text for which that is ambiguous has its windows in ``by_words``.
    """
    fast = F.transform(_beside("sorted", lambda x, y: _same_hash(x, y) & _same_words(x, y)), lambda x: x.bitwiseAND(_mask()))
    exact = F.transform(_beside("by_words", lambda x, y: x["three"] == y["three"]), lambda window: window["at"])
    return F.sort_array(F.when(F.col("by_words").isNull(), fast).otherwise(exact))


def text_counts(docs: DataFrame) -> DataFrame:
    """The columns of docs without text, and counts over each text."""
    text = F.col("_text")
    kept = [F.col(c) for c in ("doc_id", "lang", "source")]
    split = docs.select(*kept, filled(F.col("text")).alias("_text")).select(
        "*", words_of(text, SPACE_BREAK).alias("words")
    )
    no_place = F.lit(~((1 << _PLACE_BITS) - 1)).cast("long")

    def window(word: Column, i: Column) -> Column:
        hashed = F.xxhash64(word, F.get("words", i + 1), F.get("words", i + 2))
        return hashed.bitwiseAND(no_place).bitwiseOR(i.cast("long"))

    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counted = split.select(
        *kept,
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.concat_ws("", "words")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.sort_array(F.slice(F.transform("words", window), 1, F.greatest(F.size("words") - 2, F.lit(0)))).alias("sorted"),
    )
    counted = counted.select("*", F.when(_ambiguous(), _windows_by_words()).alias("by_words"))
    places = counted.select("*", _repeated_places().alias("places"))
    covered = F.transform("places", lambda p, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get("places", i + 1) - p, F.lit(3).cast("long"))))
    return places.select(
        *kept,
        "n_words",
        "word_chars",
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_repeat_words"),
    )


def ratios(counts: DataFrame) -> DataFrame:
    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)

    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counts.withColumns(
        {
            "base_failed": failed,
            "symbol_share": share("n_symbols", "word_chars"),
            "dup_line_share": share("n_dup_lines", "n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"),
            "word_length": share("word_chars", "n_words"),
        }
    )


def thresholds(measured: DataFrame, spread: float = SPREAD, least: int = LEAST) -> DataFrame:
    """lang, source, and a lower and upper fence for each ratio, from documents that pass the base rule."""
    passed = measured.filter(~F.col("base_failed"))
    sketched = stored(
        passed.groupBy("lang", "source").agg(
            F.count("*").alias("n"), *(F.kll_sketch_agg_double(r, F.lit(SKETCH_K)).alias(r) for r in FLOORS)
        ),
        "sketches",
    )

    def merged(*keys: str) -> DataFrame:
        return sketched.groupBy(*keys).agg(F.sum("n").alias("n"), *(F.kll_merge_agg_double(r, F.lit(SKETCH_K)).alias(r) for r in FLOORS))

    def fences(sketches: DataFrame, name: str) -> Column:
        made = []
        for r, floor in FLOORS.items():
            q1, q3 = (F.kll_sketch_get_quantile_double(sketches[r], F.lit(q)) for q in (0.25, 0.75))
            width = F.greatest(q3 - q1, F.lit(floor)) * spread
            made += [(q1 - width).alias(f"{r}_low"), (q3 + width).alias(f"{r}_high")]
        return F.struct(sketches["n"].alias("n"), *made).alias(name)

    own = sketched.select("lang", "source", fences(sketched, "own"))
    by_lang = merged("lang")
    by_lang = by_lang.select(F.col("lang").alias("of"), fences(by_lang, "by_lang"))
    overall = merged()
    overall = overall.select(fences(overall, "overall"))
    joined = own.join(by_lang, F.col("lang").eqNullSafe(F.col("of"))).join(F.broadcast(overall))
    chosen = (
        F.when(F.col("own.n") >= least, F.col("own"))
        .when(F.col("by_lang.n") >= least, F.col("by_lang"))
        .otherwise(F.col("overall"))
    )
    return joined.select("lang", "source", chosen.alias("f")).select("lang", "source", "f.*").drop("n")


def judged(docs: DataFrame, spread: float = SPREAD, least: int = LEAST) -> DataFrame:
    """One row per document: its counts, base_failed, and kept."""
    measured = ratios(stored(text_counts(docs), "counts"))
    bounds = stored(thresholds(measured, spread, least), "thresholds")
    bounds = bounds.withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    same = measured["lang"].eqNullSafe(bounds["of_lang"]) & measured["source"].eqNullSafe(bounds["of_source"])
    # Means of words have two fences; of the shares only large values are faults.
    outside = (F.col("word_length") < F.col("word_length_low")) | (F.col("word_length") > F.col("word_length_high"))
    for r in ("symbol_share", "dup_line_share", "repeat_share"):
        outside = outside | (F.col(r) > F.col(f"{r}_high"))
    return measured.join(bounds, same, "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & ~F.coalesce(outside, F.lit(False))).alias("kept"),
    )
