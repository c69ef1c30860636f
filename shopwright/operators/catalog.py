"""Categories, products and price histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopwright.functions import subcategory_id
from shopwright.operators.nesting import PART_ROWS, nest, unnest
from shopwright.operators.ordered import PROBE, Heavy, ordered


def product_catalog(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Products with a ``category`` struct copied from their category.

    The subcategory is always the one whose id ends in 01. Products of unknown
    categories stay, with nulls. Of several documents under one category id the one
    with the greatest name counts, then the one whose JSON text is greatest.
    """
    wanted = subcategory_id("category_id", 1)
    document = F.struct(F.col("name").alias("__name"), F.col("subcategories").alias("__subs"))
    rank = F.struct("name", F.to_json(F.struct("subcategories")))
    known = categories.groupBy("category_id").agg(F.max_by(document, rank).alias("__d")).select("category_id", "__d.*")
    first = F.get(F.filter("__subs", lambda s: s["subcategory_id"] == wanted), F.lit(0))
    return (
        products.join(known, "category_id", "left")
        .withColumn("__sub", first)
        .withColumn(
            "category",
            F.struct(
                "category_id",
                F.col("__name").alias("name"),
                F.col("__sub.subcategory_id").alias("subcategory_id"),
                F.col("__sub.name").alias("subcategory_name"),
            ),
        )
        .drop("__name", "__subs", "__sub")
    )


def category_tree(pairs: DataFrame) -> DataFrame:
    """Category documents from (category_id, subcategory) rows.

    Subcategories are numbered from 0 in name order. Duplicates collapse before
    the shuffle, and an array is as long as the category's subcategory list.
    """
    distinct = pairs.groupBy("category_id").agg(
        F.array_sort(F.collect_set("subcategory")).alias("names")
    )
    return distinct.select(
        "category_id",
        F.col("category_id").alias("name"),
        F.transform(
            "names",
            lambda name, i: F.struct(
                subcategory_id("category_id", i).alias("subcategory_id"), name.alias("name")
            ),
        ).alias("subcategories"),
    )


def sort_price_history(
    products: DataFrame, *, part_rows: int = PART_ROWS, heavy: Heavy = PROBE
) -> DataFrame:
    """Order each product's price list by date and derive prices and creation date.

    base_price is the first price, current_price the last, over the whole list.
    ``products`` may hold a list in several parts (see ``nest``); the result numbers
    its parts by date, from 0. Products without prices keep an empty list and nulls.
    """
    derived = ("price_history", "part", "base_price", "current_price", "creation_date")
    facts = products.filter("part = 0") if "part" in products.columns else products
    facts = facts.select(*[c for c in products.columns if c not in derived])
    changes = unnest(products.select("product_id", "price_history"), "price_history")
    lists = nest(
        changes, ["product_id"], ["date", "price"], ["price", "date"], "price_history", part_rows=part_rows, heavy=heavy
    )
    kind = lists.schema["price_history"].dataType.simpleString()
    known = facts.join(price_summary(changes), "product_id", "left")
    # Every part is joined with its product's one row, as a merge keeps the rows of the right: never those of a whole list.
    # Without the hint Spark may take the lists for as small as their file, and broadcast them.
    there = known.filter("changes is not null").drop("changes")
    columns = [*there.columns, "part", "price_history"]
    listed = lists.join(there.hint("merge"), "product_id").select(*columns)
    empty = known.filter("changes is null").withColumns({"part": F.lit(0), "price_history": F.array().cast(kind)})
    return listed.unionByName(empty.select(*columns))


def price_timeline(
    changes: DataFrame, tie: Sequence[str] = (), *, heavy: Heavy = PROBE
) -> DataFrame:
    """Number price changes (product_id, date, price) from 1, by date, then price."""
    return ordered(changes, ["product_id"], ["date", "price", *tie], position="seq", heavy=heavy)


def price_summary(changes: DataFrame) -> DataFrame:
    """First and last price and creation date per product, without sorting."""
    moment = F.struct("date", "price")
    return changes.groupBy("product_id").agg(
        F.min("date").alias("creation_date"),
        F.min_by("price", moment).alias("base_price"),
        F.max_by("price", moment).alias("current_price"),
        F.count("*").alias("changes"),
    )


def purchasable_products(products: DataFrame) -> DataFrame:
    """Active products with stock left."""
    return products.filter(F.col("is_active") & (F.col("current_stock") > 0))
