"""Stock operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopwright.operators.ordered import PROBE, Heavy, ordered


def _queues(products, demands, order, heavy) -> DataFrame:
    """product_id, stock and the queue of demands that could be filled at all.

    Stock only falls. So once a demand for q units is refused, every later demand
    for q units is refused too, and the filled demands for q units are the first
    ones: at most stock / q of them. Whatever comes later cannot change the
    outcome. Per product this leaves a queue bounded by the stock (about
    stock * ln(stock)), however often the product is asked for. The greatest stock of
    all products is a bound that needs no join: demands beyond it go before the
    shuffle by product, so a hot product's history never meets in one task.
    """
    most = products.agg(F.max("current_stock").cast("bigint")).scalar()
    placed = ordered(
        demands.filter(F.col("quantity") > 0),
        ["product_id", "quantity"],
        order,
        position="turn",
        heavy=heavy,
    ).filter(F.col("turn") * F.col("quantity") <= most)
    stock = products.select("product_id", F.col("current_stock").cast("bigint").alias("stock"))
    first = [*order, "quantity", "turn"]
    rest = [c for c in demands.columns if c not in first and c != "product_id"]
    return (
        placed.join(stock, "product_id")
        .filter(F.col("turn") * F.col("quantity") <= F.col("stock"))
        .groupBy("product_id")
        .agg(
            F.first("stock").alias("stock"),
            F.array_sort(F.collect_list(F.struct(*first, *rest))).alias("queue"),
        )
    )


def _serve(queues: DataFrame) -> DataFrame:
    """Add ``end``: units left, demands filled, and the refusals that set a new lowest size.

    After a refusal for q units less than q is left, so all demands from q units
    up are refused from there on. The refusals of ever smaller sizes describe the
    outcome of the whole queue.
    """
    none = F.lit(0).cast("bigint")
    asks = F.transform("queue", lambda d, i: F.struct(i.alias("at"), d["quantity"].alias("quantity")))
    start = F.struct(
        F.col("stock").alias("left"),
        none.alias("filled"),
        F.array().cast("array<struct<at:int,quantity:bigint>>").alias("refusals"),
    )

    def step(state, ask):
        size, refusals = ask["quantity"], state["refusals"]
        lowest = F.get(refusals, F.size(refusals) - 1)["quantity"]
        filled = F.struct(
            (state["left"] - size).alias("left"),
            (state["filled"] + 1).alias("filled"),
            refusals.alias("refusals"),
        )
        refused = F.struct(
            state["left"].alias("left"),
            state["filled"].alias("filled"),
            F.concat(refusals, F.array(ask)).alias("refusals"),
        )
        return (
            F.when(state["left"] >= size, filled)
            .when(lowest.isNull() | (size < lowest), refused)
            .otherwise(state)
        )

    return queues.withColumn("end", F.aggregate(asks, start, step))


def stock_depletion(
    products: DataFrame,
    demands: DataFrame,
    order: Sequence[str],
    *,
    heavy: Heavy = PROBE,
) -> DataFrame:
    """Serve demands in order: take the quantity if the stock covers it, else skip that demand.

    ``demands`` has product_id, whole-unit quantity and the order columns. Gives
    one row per product; demands for unknown products are refused and not listed.
    A demand for 0 units is always filled, one for less or for null refused.
    """
    needed = demands.select("product_id", "quantity", *order)
    served = _serve(_queues(products, needed, order, heavy)).select(
        "product_id", "end.left", "end.filled"
    )
    asked = demands.groupBy("product_id").agg(
        F.count("*").alias("demands"), F.count_if(F.col("quantity") == 0).alias("for_nothing")
    )
    filled = F.coalesce("filled", F.lit(0)) + F.coalesce("for_nothing", F.lit(0))
    return (
        products.select("product_id", F.col("current_stock").cast("bigint").alias("stock"))
        .join(asked, "product_id", "left")
        .join(served, "product_id", "left")
        .select(
            "product_id",
            F.col("stock").alias("initial_stock"),
            F.coalesce("left", "stock").alias("remaining_stock"),
            filled.alias("filled"),
            (F.coalesce("demands", F.lit(0)) - filled).alias("refused"),
        )
    )


def filled_demands(
    products: DataFrame,
    demands: DataFrame,
    order: Sequence[str],
    *,
    heavy: Heavy = PROBE,
) -> DataFrame:
    """The demands that :func:`stock_depletion` fills, with all their columns."""

    def filled(demand, at):
        return ~F.exists(
            "end.refusals", lambda r: (r["at"] <= at) & (r["quantity"] <= demand["quantity"])
        )

    served = _serve(_queues(products, demands, order, heavy)).select(
        "product_id", F.inline(F.filter("queue", filled))
    )
    for_nothing = demands.filter("quantity = 0").join(products.select("product_id"), "product_id", "left_semi")
    return served.select(*demands.columns).unionByName(for_nothing.select(*demands.columns))


def remaining_stock(products: DataFrame, column: str = "current_stock") -> DataFrame:
    """Units left over all products."""
    return products.agg(F.sum(column).cast("bigint").alias("remaining"))
