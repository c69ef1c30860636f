"""Price lists of whole categories: long ones in parts, put together as texts."""

from __future__ import annotations

from datetime import datetime, timedelta

from shopwright.operators import catalog
from shopwright.plans.queries import QUERIES
from shopwright.schemas import TABLES

DAY = datetime(2024, 1, 1)


def test_a_category_is_put_together_from_the_texts_of_its_parts(spark, tmp_path):
    goods = [(i, "n", "Brand#1" if i < 3 else "Brand#2", "t", 5, 1.0) for i in range(4)]
    # 330 changes of one category, among them a whole part of 100 without a price.
    lines = [(i, i % 3, 1, 1.0, None if 100 <= i < 200 else float(i), 0.0, DAY + timedelta(days=i)) for i in range(330)]
    lines += [(999, 3, 1, 2.0, 9.0, 0.0, DAY), (1000, None, 1, 1.0, 1.0, 0.0, DAY)]
    for name, rows in (("part", goods), ("lineitem", lines)):
        spark.createDataFrame(rows, TABLES[name]).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = QUERIES["price_history_by_category"](spark, str(tmp_path))
    plan = got._jdf.queryExecution().executedPlan().toString()
    # Lists are made once, and no row holds a category's list.
    assert "lineitem.parquet" not in plan
    assert "collect_list(struct(part, part" in plan and "price_history, price_history" not in plan
    found = {r["category_id"]: r for r in got.collect()}
    assert set(found) == {"Brand#1", "Brand#2"}
    long, short = found["Brand#1"], found["Brand#2"]
    assert long["changes"] == 330 and (long["base_price"], long["current_price"]) == (0.0, 329.0)
    assert long["prices"] == " ".join(str(i) for i in range(330) if not 100 <= i < 200)
    assert (short["changes"], short["prices"], short["creation_date"]) == (1, "4", DAY)


def test_products_without_prices_twice_or_without_id_keep_their_rows(spark):
    kind = "product_id string, name string, price_history array<struct<price double, date timestamp>>"
    late, early = (2.0, DAY + timedelta(days=1)), (5.0, DAY)
    rows = [("a", "x", [late]), ("a", "y", [early]), ("b", "z", []), ("c", "w", None), (None, "v", [late])]
    got = catalog.sort_price_history(spark.createDataFrame(rows, kind), part_rows=1)
    assert got.columns == ["product_id", "name", "creation_date", "base_price", "current_price", "part", "price_history"]
    # A list is one product's, whatever number of rows it came in; one without id has no list.
    assert sorted((r["product_id"] or "", r["name"], r["part"], [h["price"] for h in r["price_history"]], r["base_price"]) for r in got.collect()) == [
        ("", "v", 0, [], None),
        ("a", "x", 0, [5.0], 5.0),
        ("a", "x", 1, [2.0], 5.0),
        ("a", "y", 0, [5.0], 5.0),
        ("a", "y", 1, [2.0], 5.0),
        ("b", "z", 0, [], None),
        ("c", "w", 0, [], None),
    ]
