"""Entity files in JSON or Parquet, read with the fixed schemas.

A JSON file may hold one array on one line or one record per line. Prefer the
latter, or Parquet, for anything large: an array file cannot be split. Missing
paths are reported by Spark when the DataFrame is made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopwright.schemas import CELLS, ENTITIES
from shopwright.shared import stored

BROKEN, FILE = "_broken", "_read_from"


def read_entity(spark: SparkSession, entity: str, path: str, fmt: str = "json") -> DataFrame:
    """Users, categories, products, transactions or sessions.

    ``path`` is a file or a directory; from a directory of JSON only files named
    ``*.json`` are taken.
    """
    reader = spark.read.schema(ENTITIES[entity])
    if fmt == "json":
        folder_only = not path.endswith(".json")
        reader = reader.option("pathGlobFilter", "*.json") if folder_only else reader
        return reader.json(path)
    return reader.format(fmt).load(path)


def read_checked(spark: SparkSession, entity: str, path: str) -> tuple[DataFrame, DataFrame]:
    """Records of JSON Lines that fit the entity's schema, and (file, record) of those that do not.

    One scan sorts them out and stores both; a line that is no JSON, or has a value of another type, is broken as a
    whole. Blank lines are no records.
    """
    reader = spark.read.schema(T.StructType([*ENTITIES[entity].fields, T.StructField(BROKEN, T.StringType())]))
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BROKEN)
    if not path.endswith(".json"):
        reader = reader.option("pathGlobFilter", "*.json")
    # Stored, as Spark does not parse a line whose record nobody asks for.
    rows = stored(reader.json(path).select("*", F.col("_metadata.file_path").alias(FILE)), f"checked-{entity}")
    good = rows.filter(F.col(BROKEN).isNull()).drop(BROKEN, FILE)
    return good, rows.filter(F.col(BROKEN).isNotNull()).select(F.col(FILE).alias("file"), F.col(BROKEN).alias("record"))


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CELLS).parquet(path)


def register_views(**tables: DataFrame) -> None:
    """Register DataFrames as temporary views for use in SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
