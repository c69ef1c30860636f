"""Revenue and order operators.

An *item* row has product_id, quantity and subtotal, plus whatever its
transaction brings along. Totals of one key are summed before any join, so a
best-selling product or a very active user is one row by the time it is shuffled
for the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopwright.functions import amount, money_sum
from shopwright.operators.nesting import nest, unnest
from shopwright.operators.ordered import PROBE, Heavy
from shopwright.shared import stored


def explode_items(transactions: DataFrame) -> DataFrame:
    """One row per line item next to its transaction's columns.

    The transaction's own subtotal is kept as order_subtotal.
    """
    if "subtotal" in transactions.columns:
        transactions = transactions.withColumnRenamed("subtotal", "order_subtotal")
    return unnest(transactions, "items")


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Per-column replacement of nulls."""
    return df.na.fill(defaults)


def product_sales(items: DataFrame) -> DataFrame:
    """product_id, exact revenue, quantity."""
    return items.groupBy("product_id").agg(
        money_sum("subtotal").alias("revenue"),
        F.sum("quantity").cast("bigint").alias("total_quantity"),
    )


def product_totals(items: DataFrame) -> DataFrame:
    """product_id, revenue of its items, order_revenue (each order's total once per item) and quantity, exact."""
    return items.groupBy("product_id").agg(
        money_sum("subtotal").alias("revenue"),
        money_sum("total").alias("order_revenue"),
        F.sum("quantity").cast("bigint").alias("total_quantity"),
    )


def category_totals(per_product: DataFrame, products: DataFrame) -> DataFrame:
    """The sums of ``product_totals`` per category."""
    return (
        per_product.join(products.select("product_id", "category_id"), "product_id")
        .groupBy("category_id")
        .agg(F.sum("revenue").alias("revenue"), F.sum("order_revenue").alias("order_revenue"))
    )


def top_products(items: DataFrame, n: int = 10) -> DataFrame:
    """The n products with the highest item revenue; ties go to the smaller id."""
    return (
        product_sales(items)
        .orderBy(F.desc("revenue"), "product_id")
        .limit(n)
        .select(
            "product_id", amount("revenue").alias("total_revenue"), "total_quantity"
        )
    )


def revenue_by_category(items: DataFrame, products: DataFrame) -> DataFrame:
    """Item revenue per product category, largest first."""
    per_product = items.groupBy("product_id").agg(money_sum("subtotal").alias("revenue"))
    return _per_category(per_product, products)


def revenue_by_category_order_total(items: DataFrame, products: DataFrame) -> DataFrame:
    """Order total counted once per item, per category.

    An order with several items adds its total several times; this is a measure
    of the orders a category takes part in, not of its own sales.
    """
    per_product = items.groupBy("product_id").agg(money_sum("total").alias("revenue"))
    return _per_category(per_product, products)


def _per_category(per_product: DataFrame, products: DataFrame) -> DataFrame:
    return (
        per_product.join(products.select("product_id", "category_id"), "product_id")
        .groupBy("category_id")
        .agg(F.sum("revenue").alias("revenue"))
        .orderBy(F.desc("revenue"), "category_id")
        .select("category_id", amount("revenue").alias("total_revenue"))
    )


def revenue_by_state(users: DataFrame, transactions: DataFrame, n: int = 10) -> DataFrame:
    """The n states whose users spent most. Null is a state of its own."""
    spend = transactions.groupBy("user_id").agg(money_sum("total").alias("revenue"))
    return (
        users.select("user_id", F.col("geo_data.state").alias("state"))
        .join(spend, "user_id")
        .groupBy("state")
        .agg(F.sum("revenue").alias("revenue"))
        .orderBy(F.desc("revenue"), "state")
        .limit(n)
        .select("state", amount("revenue").alias("total_revenue"))
    )


def daily_sales(transactions: DataFrame) -> DataFrame:
    """Order totals per calendar day, oldest first."""
    kind = transactions.schema["timestamp"].dataType
    day = F.date_trunc("day", F.col("timestamp").cast("timestamp"))
    if kind.typeName() == "timestamp_ntz":
        day = day.cast(kind)
    return (
        transactions.groupBy(day.alias("day"))
        .agg(amount(money_sum("total")).alias("total_revenue"))
        .orderBy("day")
    )


def order_totals(items: DataFrame, keys: Sequence[str], rate: Column) -> DataFrame:
    """Subtotal, discount and total per order.

    ``rate`` is an aggregate or literal giving the order's discount rate.
    Amounts are decimals, rounded half up to cents.
    """
    subtotal = F.round(money_sum("subtotal"), 2).cast("decimal(18,2)")
    return (
        items.groupBy(*keys)
        .agg(subtotal.alias("subtotal"), rate.cast("decimal(6,4)").alias("rate"))
        .withColumn("discount", F.round(F.col("subtotal") * F.col("rate"), 2))
        .withColumn("total", F.round(F.col("subtotal") - F.col("discount"), 2))
        .select(
            *keys,
            *[F.col(c).cast("decimal(18,2)").alias(c) for c in ("subtotal", "discount", "total")],
        )
    )


def nest_transactions(
    transactions: DataFrame,
    items: DataFrame,
    key: str,
    order: Sequence[str],
    fields: Sequence[str],
    *,
    heavy: Heavy = PROBE,
    part_rows: int | None = None,
) -> DataFrame:
    """Transactions with their items as an array. Orders without items drop out.

    Orders with more items than one array may hold continue in further parts.
    """
    sized = {} if part_rows is None else {"part_rows": part_rows}
    return transactions.join(nest(items, [key], order, fields, "items", heavy=heavy, **sized), key)


def lookup_products(
    items: DataFrame,
    products: DataFrame,
    fields: Sequence[str],
) -> DataFrame:
    """Each item, once, with the array of the different products that have its product_id.

    Items without a match keep an empty array; null ids match null ids. The array
    is as long as there are different documents under one id.
    """
    matches = products.groupBy(F.col("product_id").alias("__id")).agg(
        F.array_sort(F.collect_set(F.struct(*fields))).alias("product_info")
    )
    # Stored, so that the join does not sit on the aggregation and Spark can split a popular product.
    matches = stored(matches, "matches")
    kind = matches.schema["product_info"].dataType.simpleString()
    return (
        items.join(matches, items["product_id"].eqNullSafe(matches["__id"]), "left")
        .drop("__id")
        .withColumn("product_info", F.coalesce("product_info", F.array().cast(kind)))
    )
