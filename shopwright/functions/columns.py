"""Scalar building blocks. Everything here stays inside JVM code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000

# Fixed value: row keys store this number minus the epoch second, so that a
# user's newest session sorts first.
KEY_CEILING = 999_999_999_999


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    """An amount as a decimal with six places, rounded half up.

    Sums of decimals do not depend on row order. Amounts have up to 22 digits before
    the point; larger ones and those that are not finite are an error.
    """
    value = _col(c)
    finite = value.isNull() | (value - value == 0)
    wrong = F.raise_error(F.lit("an amount is not finite")).cast("decimal(28,6)")
    return F.when(finite, value.cast("decimal(28,6)")).otherwise(wrong)


def money_sum(c: Column | str) -> Column:
    """The sum of amounts, as the sum of ``money`` would be, mostly in longs.

    An amount of whole cents that its double states exactly is added as two limbs, of which neither
    can overflow before 2^43 rows. Only others, and amounts from 5 billion on, are decimals.
    """
    value = _col(c).cast("double")
    cents = F.rint(value * 100)
    plain = (cents / 100 == value) & (F.abs(cents) < 1 << 39)
    whole = F.when(plain, cents.cast("bigint"))
    high, low = F.sum(F.shiftright(whole, 20)), F.sum(whole.bitwiseAND(F.lit((1 << 20) - 1).cast("bigint")))
    rest = F.sum(F.when(~F.coalesce(plain, F.lit(False)), money(c)))
    joined = high.cast("decimal(20,0)") * F.lit(1 << 20).cast("decimal(7,0)") + low.cast("decimal(20,0)")
    summed = (joined.cast("decimal(30,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(38,6)")
    both = F.coalesce(summed, F.lit(0).cast("decimal(38,6)")) + F.coalesce(rest, F.lit(0).cast("decimal(38,6)"))
    return F.when(high.isNotNull() | rest.isNotNull(), both.cast("decimal(38,6)"))


def amount(c: Column | str) -> Column:
    """A sum of money as a double."""
    return _col(c).cast("double")


def plain_number(c: Column | str) -> Column:
    """A double as text in full precision, without an exponent between 1e-18 and 1e19."""
    text = _col(c).cast("string")
    digits = text.try_cast("decimal(38,18)").cast("string")
    plain = F.regexp_replace(F.regexp_replace(digits, "0+$", ""), "[.]$", ".0")
    return F.when(text.contains("E"), F.coalesce(F.nullif(plain, F.lit("0.0")), text)).otherwise(text)


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since 1970. Zone-less timestamps are read in the session time zone."""
    return F.unix_micros(_col(ts).cast("timestamp"))


def whole_seconds(micros: Column) -> Column:
    """Whole seconds in a span of microseconds, in integer arithmetic throughout."""
    return F.call_function("div", micros, F.lit(MICROS))


def add_seconds(ts: Column | str, seconds: Column | str) -> Column:
    return F.timestamp_add("SECOND", _col(seconds), _col(ts))


def iso_text(ts: Column | str) -> Column:
    """ISO-8601 text without a zone; six decimals, or none on a whole second."""
    whole = F.pmod(epoch_micros(ts), F.lit(MICROS)) == 0
    return F.when(whole, F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss")).otherwise(
        F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )


def reverse_seconds(ts: Column | str) -> Column:
    """Key ceiling minus the epoch second, rounded towards zero as a whole number."""
    left = F.lit(KEY_CEILING * MICROS) - epoch_micros(ts)
    return whole_seconds(left)


def row_key(user: Column | str, ts: Column | str) -> Column:
    """Wide-row key ``user:reverse seconds``."""
    return F.concat(_col(user).cast("string"), F.lit(":"), reverse_seconds(ts).cast("string"))


def padded_id(prefix: str, width: int, number: Column | str) -> Column:
    """``prefix`` plus a zero-padded number; longer numbers are kept whole."""
    return F.format_string(f"{prefix}%0{width}d", _col(number))


def subcategory_id(category_id: Column | str, index: Column | int) -> Column:
    """Subcategory id built from the last three characters of the category id."""
    position = F.lit(index) if isinstance(index, int) else index
    return F.concat(
        F.lit("sub_"),
        F.right(_col(category_id), F.lit(3)),
        F.lit("_"),
        F.lpad(position.cast("string"), 2, "0"),
    )


def title_case(c: Column | str) -> Column:
    return F.initcap(_col(c))


def map_value(m: Column | str, key: Column | str, default) -> Column:
    """Value under ``key``, or ``default`` where the map or the key is missing."""
    wanted = F.lit(key) if isinstance(key, str) else key
    return F.coalesce(F.try_element_at(_col(m), wanted), F.lit(default))


def json_text(c: Column | str) -> Column:
    """JSON text of a nested value, or the empty string where it is null."""
    return F.coalesce(F.to_json(_col(c)), F.lit(""))
