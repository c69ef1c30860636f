"""Wide rows as a long table of cells: row_key, family, qualifier, value, version, put.

Values are text. A cell may have several versions; a read sees the newest of each
cell, so a row can mix cells of several writes. ``version`` numbers the write, such as the
time of a batch; ``put`` orders the rows put by one write. All cells of one put share both,
so a read never mixes two puts that wrote the same cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopwright.functions import epoch_micros, iso_text, json_text, plain_number, row_key
from shopwright.functions.columns import reverse_seconds
from shopwright.operators.customers import engagement_totals, with_all_users
from shopwright.operators.sessions import explode_page_views

CELL = ["row_key", "family", "qualifier"]

# Qualifiers of a session row, next to the columns they come from.
SESSION_CELLS = (
    ("session_id", "session_id"),
    ("start_time", "start_time"),
    ("end_time", "end_time"),
    ("duration", "duration_seconds"),
    ("geo_data", "geo_data"),
    ("device_profile", "device_profile"),
    ("viewed_products", "viewed_products"),
    ("conversion_status", "conversion_status"),
)
PAGE_VIEW_CELLS = ("timestamp", "page_type", "product_id", "category_id", "view_duration")


def cell_text(df: DataFrame, column: str) -> Column:
    """Cell value of a column: JSON for nested values, ISO text for times, empty for null."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return json_text(column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = iso_text(column)
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        text = plain_number(F.col(column).cast("double"))
    else:
        text = F.col(column).cast("string")
    return F.coalesce(text, F.lit(""))


def _named(pairs: list[tuple[Column, Column]]) -> Column:
    return F.array(*[F.struct(q.alias("qualifier"), v.alias("value")) for q, v in pairs])


def _as_cells(df: DataFrame, key: Column, family: str, named: Column, version: Column, put: Column) -> DataFrame:
    return df.select(
        key.alias("row_key"), F.lit(family).alias("family"), F.inline(named), version.alias("version"), put.alias("put")
    )


def write_time() -> Column:
    """Version of a write made now: microseconds since 1970."""
    return F.unix_micros(F.current_timestamp())


def put_order(start: str = "start_time", tie: str = "session_id") -> Column:
    """Order of session rows in one write: by start, then by id."""
    return F.concat(F.lpad((epoch_micros(start) + (1 << 62)).cast("string"), 19, "0"), F.lit(":"), F.col(tie))


def session_cells(sessions: DataFrame, version: Column, page_views: DataFrame | None = None) -> DataFrame:
    """Cells of session rows: eight about the session and five per page view.

    The layout is the same for any number of page views and products. Page views come nested in
    ``sessions`` or as long rows with session_id, user_id, start_time of the session and a
    position ``pv`` from 0. ``version`` is evaluated on both.
    """
    version, put = version.cast("bigint"), put_order()
    key = row_key("user_id", "start_time")
    about = _named([(F.lit(q), cell_text(sessions, c)) for q, c in SESSION_CELLS])
    session_data = _as_cells(sessions, key, "session_data", about, version, put)
    if page_views is None:
        page_views = explode_page_views(sessions)
    number = F.concat(F.lit("pv_"), F.col("pv").cast("string"), F.lit("_"))
    per_view = _named(
        [(F.concat(number, F.lit(c)), cell_text(page_views, c)) for c in PAGE_VIEW_CELLS]
    )
    return session_data.unionByName(_as_cells(page_views, key, "page_views", per_view, version, put))


def metric_cells(
    df: DataFrame, key: str, value: str, family: str, qualifier: str, version: Column
) -> DataFrame:
    """One cell per group of an aggregate, keyed by the group, in full precision.

    Not-a-number and infinities are published as NaN, Infinity and -Infinity, null as a null value.
    """
    kind = df.schema[value].dataType
    number = plain_number(value) if isinstance(kind, T.DoubleType) else F.col(value).cast("string")
    return df.select(
        F.col(key).cast("string").alias("row_key"),
        F.lit(family).alias("family"),
        F.lit(qualifier).alias("qualifier"),
        number.alias("value"),
        version.cast("bigint").alias("version"),
        F.lit("").alias("put"),
    )


def retain_versions(cells: DataFrame, n: int = 3) -> DataFrame:
    """The n newest versions of each cell.

    Spark turns the rank filter into a limit per group that also runs before the
    shuffle, so a much-rewritten cell sends n rows per task and not its history.
    """
    newest = Window.partitionBy(*CELL).orderBy(F.desc("version"), F.desc("put"), F.desc("value"))
    return cells.withColumn("__n", F.row_number().over(newest)).filter(F.col("__n") <= n).drop("__n")


def latest_cells(cells: DataFrame) -> DataFrame:
    """The newest version of each cell. Cells of older writes stay where no newer one has them."""
    newest = F.max_by(F.struct("value", "version", "put"), F.struct("version", "put", "value"))
    return cells.groupBy(*CELL).agg(newest.alias("__top")).select(*CELL, "__top.*")


def wide_rows(cells: DataFrame) -> DataFrame:
    """One row per row_key: a map from "family:qualifier" to the newest value of each cell.

    A row must fit into memory, as it does for its readers.
    """
    entry = F.struct(F.concat_ws(":", "family", "qualifier").alias("cell"), "value")
    return latest_cells(cells).groupBy("row_key").agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("cells")
    )


def rows_between(cells: DataFrame, first_key: str | Column, stop_key: str | Column) -> DataFrame:
    """The newest cells with first_key <= row_key < stop_key."""
    return latest_cells(cells.filter((F.col("row_key") >= first_key) & (F.col("row_key") < stop_key)))


def rows_of_user(cells: DataFrame, user: str, start, end) -> DataFrame:
    """The newest cells of a user's sessions in a time range, found by row key alone.

    The key holds reverse time, so the scan starts at the range's end.
    """
    begin, finish = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    first = F.concat(F.lit(f"{user}:"), reverse_seconds(finish).cast("string"))
    stop = F.concat(F.lit(f"{user}:"), reverse_seconds(begin).cast("string"))
    return rows_between(cells, first, stop)


def keyed_sessions(cells: DataFrame) -> DataFrame:
    """One row per session row: user_id, reverse_seconds and the text of its duration cell.

    User and time come from the row key. The newest duration wins; a row without
    one has a null. Only session_data cells are read, which every session row has.
    """
    own = cells.filter("family = 'session_data'")
    newest = F.max_by("value", F.when(F.col("qualifier") == "duration", F.struct("version", "put", "value")))
    return own.groupBy("row_key").agg(newest.alias("duration")).select(
        F.regexp_extract("row_key", "^(.*):[0-9]+$", 1).alias("user_id"),
        F.regexp_extract("row_key", ":([0-9]+)$", 1).cast("bigint").alias("reverse_seconds"),
        "duration",
    )


def engagement_from_cells(users: DataFrame, cells: DataFrame, start, end) -> DataFrame:
    """Sessions and seconds of every user in a time range, from the cell table.

    One pass over the table replaces a key-range read per user. The bounds are
    those of the key range: end included, start excluded.
    """
    first = reverse_seconds(F.lit(end).cast("timestamp"))
    stop = reverse_seconds(F.lit(start).cast("timestamp"))
    found = keyed_sessions(cells).filter(
        (F.col("reverse_seconds") >= first) & (F.col("reverse_seconds") < stop)
    )
    return with_all_users(users, engagement_totals(found, "duration"))
