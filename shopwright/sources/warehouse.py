"""Retail entities from the star-schema tables and the event stream table.

Column names follow the entities; ids stay numbers, which shuffle and join
cheaper than padded text.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopwright.functions import amount, epoch_micros, money_sum, padded_id, whole_seconds
from shopwright.operators import sessions as S
from shopwright.operators.catalog import category_tree
from shopwright.operators.ordered import Heavy
from shopwright.schemas import TABLES

ITEM_ORDER = ["line", "product_id", "quantity", "subtotal", "ship_date"]
VIEW_ORDER = ["ts", "event_id"]
SESSION_KEYS = ["user_id", "session_no"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def users(spark: SparkSession, folder: str) -> DataFrame:
    """user_id, name, geo_data{state, country}, balance, segment."""
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    places = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
    customer = table(spark, folder, "customer")
    return customer.join(places, customer["c_nationkey"] == places["n_nationkey"], "left").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("name"),
        F.struct(F.col("n_name").alias("state"), F.col("r_name").alias("country")).alias("geo_data"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )


def people(spark: SparkSession, folder: str) -> DataFrame:
    """Users without their places."""
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )


def user_ids(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"))


def buyers(spark: SparkSession, folder: str) -> DataFrame:
    """Users with their purchases and the date of the first one as registration date, from one pass over orders."""
    bought = transactions(spark, folder).groupBy("user_id").agg(
        F.min("timestamp").alias("registration_date"),
        amount(money_sum("total")).alias("total_spend"),
        F.count("*").alias("purchase_count"),
    )
    return user_ids(spark, folder).join(bought, "user_id", "left")


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("category_id"),
        F.col("p_type").alias("subcategory"),
        F.col("p_retailprice").alias("base_price"),
        initial_stock().alias("current_stock"),
        (F.col("p_size") > 2).alias("is_active"),
    )


def initial_stock() -> Column:
    """Units at the start, from 50 to 949 depending on the product."""
    return (F.lit(50) + F.pmod(F.col("p_partkey") * 37, F.lit(900))).cast("bigint")


def categories(spark: SparkSession, folder: str) -> DataFrame:
    return category_tree(products(spark, folder).select("category_id", "subcategory"))


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("timestamp"),
        F.col("o_totalprice").alias("total"),
        F.col("o_orderstatus").alias("status"),
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("transaction_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").alias("subtotal"),
        F.col("l_discount").alias("discount_rate"),
        F.col("l_shipdate").alias("ship_date"),
    )


def price_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Unit prices at the dates they were charged."""
    return items(spark, folder).select(
        "product_id",
        F.col("ship_date").alias("date"),
        (F.col("subtotal") / F.col("quantity").cast("double")).alias("price"),
    )


def events(spark: SparkSession, folder: str) -> DataFrame:
    """event_id, ts, user_id, page_type, product_id, value."""
    return table(spark, folder, "events").select(
        "event_id",
        "ts",
        "user_id",
        F.col("event_type").alias("page_type"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("product_id"),
        "value",
    )


def sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions with page-view counts and conversion status, without nested data."""
    measures: Mapping[str, tuple[str, Column]] = {
        "views": ("sum", F.lit(1).cast("bigint")),
        "bought": ("max", F.col("page_type") == "purchase"),
        "carted": ("max", F.col("page_type") == "click"),
    }
    return S.sessions_from_events(events(spark, folder), measures).withColumn(
        "conversion_status", S.conversion_status(F.col("bought"), F.col("carted"))
    ).drop("bought", "carted")


def session_documents(views: DataFrame) -> DataFrame:
    """One row per session with its distinct products, from page views that know their session."""
    spans = views.groupBy(*SESSION_KEYS).agg(
        F.first("session_start").alias("start_time"),
        F.first("session_end").alias("end_time"),
        F.count("*").alias("views"),
        F.max(F.col("page_type") == "purchase").alias("bought"),
        F.max(F.col("page_type") == "click").alias("carted"),
        F.array_sort(F.collect_set("product_id")).alias("viewed_products"),
    )
    return spans.withColumns(
        {
            "duration_seconds": whole_seconds(epoch_micros("end_time") - epoch_micros("start_time")),
            "conversion_status": S.conversion_status(F.col("bought"), F.col("carted")),
        }
    ).drop("bought", "carted")


def session_spans(spark: SparkSession, folder: str, after=None) -> DataFrame:
    """Only user_id, session_no, start_time, end_time and duration_seconds.

    With ``after``, enough events are read to tell the sessions that begin later.
    """
    clicks = table(spark, folder, "events").select("user_id", "ts")
    return S.sessions_from_events(clicks if after is None else S.events_for_sessions_after(clicks, after))


def page_views(spark: SparkSession, folder: str, heavy: Heavy) -> DataFrame:
    """Events with the session they belong to."""
    return S.assign_sessions(events(spark, folder), "event_id", heavy=heavy)


def cart_adds(views: DataFrame) -> DataFrame:
    """Clicks put value / 10 units into the cart, at that value."""
    return views.filter(F.col("page_type") == "click").withColumns(
        {"quantity": F.floor(F.col("value") / 10).cast("bigint"), "price": F.col("value")}
    )


def session_label() -> Column:
    return F.concat(
        padded_id("sess_", 6, "user_id"), F.lit("_"), F.col("session_no").cast("string")
    )


def user_label() -> Column:
    return padded_id("user_", 6, "user_id")
