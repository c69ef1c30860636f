"""Column expressions shared by the operators built from Spark functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The delimiters between words, for the two notions of a word.
ALNUM_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SPACE_BREAK = r"[\x20\x09-\x0D]+"

# Numbers in a broadcast table at most: 16 MB of them.
BROADCAST_VALUES = 2_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def filled(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower case that agrees with lowering A-Z alone wherever ASCII words are compared.

    The two characters whose lower case would turn into ASCII letters are put out
    of the way first; other letters only change among non-ASCII letters.
    """
    shielded = F.replace(text, F.lit("İ"), F.lit("ı"))
    return F.lower(F.replace(shielded, F.lit("K"), F.lit("ķ")))


def words_of(text: Column, breaks: str) -> Column:
    """The words between runs of delimiters; text must not be null."""
    return F.array_remove(F.split(text, breaks), "")


def unused(name: str, taken: list[str]) -> str:
    """name, with as many underscores behind as make it differ from the columns there."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows of constants as part of the plan; the schema is "name type, ..."."""
    fields = [field.split() for field in schema.split(", ")]
    made = [F.struct(*(F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(row, fields))) for row in rows]
    return spark.range(1).select(F.inline(F.array(*made)))


def broadcast_if_small(df: DataFrame, weight: Column | None = None, most: int = BROADCAST_VALUES) -> DataFrame:
    """df with a broadcast hint if it has few rows, counted first; ``weight`` is a row's number of values."""
    total = F.sum(F.lit(len(df.columns)) + (F.lit(0) if weight is None else weight))
    return F.broadcast(df) if (df.agg(total.alias("n")).first()["n"] or 0) <= most else df
