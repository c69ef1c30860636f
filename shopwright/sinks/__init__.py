"""Writing results: files, tables and cell tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Fixed value: records per JSON session file.
SESSIONS_PER_FILE = 5_000


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header row, replacing what was there.

    ``single_file`` sends all rows through one task: for small reports only.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str, max_records: int = 0) -> None:
    """JSON Lines files, of at most ``max_records`` records each where it is not 0.

    Times keep their microseconds.
    """
    exact = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    out = df.write.mode("overwrite").option("maxRecordsPerFile", max_records)
    out.option("timestampFormat", exact + "XXX").option("timestampNTZFormat", exact).json(path)


def write_sessions(sessions: DataFrame, path: str) -> None:
    """Sessions as JSON Lines in files of the size their readers expect."""
    write_json(sessions, path, SESSIONS_PER_FILE)


def export(df: DataFrame, path: str, fmt: str, **options) -> None:
    writers = {"csv": write_csv, "json": write_json}
    if fmt not in writers:
        raise ValueError(f"unknown format {fmt!r}, expected one of {sorted(writers)}")
    writers[fmt](df, path, **options)


def append(df: DataFrame, path: str) -> None:
    """Add rows to a Parquet table. Appending the same rows twice stores them twice."""
    df.write.mode("append").parquet(path)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, path: str | None = None) -> None:
    """Create an empty table unless it exists."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet", schema=schema)


def write_cells(cells: DataFrame, path: str, mode: str = "append") -> None:
    """Cells as Parquet in row-key order.

    Range partitioning over the whole cell key keeps files narrow in row_key, so
    a key-range read skips most of them, and splits even one very large row.
    """
    (
        cells.repartitionByRange("row_key", "family", "qualifier", "version", "put")
        .sortWithinPartitions("row_key", "family", "qualifier", "version", "put")
        .write.mode(mode)
        .parquet(path)
    )
