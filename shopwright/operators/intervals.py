"""Joins on overlapping spans: which rows lie in which ranges, each range with its own key and bounds.

Both sides are cut into bins, so that the join is one on equal keys and bins. A bin's width is a power of two
that fits the length of the longer of the two spans: at that level a span has two bins at most, or ``PARTS`` times as many,
into which a range is cut so that a key with very many rows is spread over several tasks. A row is put under
the levels that occur on the other side, of which there are at most 63, so neither a long nor
a short range multiplies rows by its length. A pair that meets in several bins counts in the first
that both have, and the bounds are compared exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopwright.functions import epoch_micros

PARTS = 16


def _level(first: Column, last: Column) -> Column:
    """The least power of two that is no less than the span's length, as an exponent."""
    length = last - first + 1
    # Bits of length - 1; exact for every long, unlike a logarithm.
    return F.when(length <= 1, 0).otherwise(F.length(F.bin(length - 1))).cast("int")


def _levels(spans: DataFrame) -> list[int]:
    """The levels that occur: at most 63 numbers."""
    return sorted(r[0] for r in spans.select("__level").distinct().collect())


def _bins(spans: DataFrame, others: Sequence[int], fine: int) -> DataFrame:
    """A row per bin of the span at its own and at the other side's greater levels: __at (level), __low (first bin), __bin."""
    greater = F.filter(F.array(*(F.lit(n) for n in others)), lambda n: n > F.col("__level"))
    own = F.when(F.col("__level") >= min(others), F.array("__level")).otherwise(F.array().cast("array<int>"))
    at = spans.withColumn("__at", F.explode(F.concat(own, greater)))
    first, last = (F.expr(f"shiftright({c}, greatest(__at - {fine}, 0))") for c in ("__first", "__last"))
    return at.withColumn("__low", first).withColumn("__bin", F.explode(F.sequence(first, last)))


def overlapping(
    rows: DataFrame,
    ranges: DataFrame,
    keys: Sequence[str],
    row_span: tuple[Column, Column],
    range_span: tuple[Column, Column],
    parts: int = PARTS,
) -> DataFrame:
    """Pairs of a row and a range with equal keys whose spans share a point, both ends included.

    Spans are long numbers; one that is empty, or has a null key or bound, meets nothing. Rows and ranges that are there
    several times give as many pairs. Other columns of both sides must differ in name, and none may begin with "__".
    """
    fine = max(0, parts.bit_length() - 1)
    sides = []
    for df, (first, last) in ((rows, row_span), (ranges, range_span)):
        spans = df.withColumns({"__first": first.cast("long"), "__last": last.cast("long")}).filter("__first <= __last")
        sides.append(spans.withColumn("__level", _level(F.col("__first"), F.col("__last"))))
    # Without any span a side has no level, and nothing meets.
    seen = [_levels(side) or [0] for side in sides]
    left, right = _bins(sides[0], seen[1], fine), _bins(sides[1], seen[0], fine)
    left = left.withColumnsRenamed({c: f"{c}_of_row" for c in ("__first", "__last", "__level", "__low")})
    # Spark takes a side for as small as its file, whatever number of bins it is cut into, and would send them through the driver.
    met = left.join(right.hint("merge"), [*keys, "__at", "__bin"])
    # At the level of the longer span, and in the first bin that both have.
    once = (F.col("__at") == F.greatest("__level_of_row", "__level")) & (F.col("__bin") == F.greatest("__low_of_row", "__low"))
    meet = (F.col("__first_of_row") <= F.col("__last")) & (F.col("__first") <= F.col("__last_of_row"))
    found = met.filter(once & meet)
    return found.drop(*(c for c in found.columns if c.startswith("__")))


def in_ranges(
    rows: DataFrame, ranges: DataFrame, keys: Sequence[str], at: str, start: str, end: str, parts: int = PARTS
) -> DataFrame:
    """Rows with the ranges (start < at <= end) of the same keys that they lie in."""
    point = epoch_micros(at)
    return overlapping(rows, ranges, keys, (point, point), (epoch_micros(start) + 1, epoch_micros(end)), parts)
