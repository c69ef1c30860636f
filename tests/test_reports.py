"""Whole jobs over a small folder of JSON entity files."""

import json

import pytest

from pyspark.sql import functions as F

from shopwright.operators import cells, customers
from shopwright.plans import reports
from shopwright.sources.entities import read_cells


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("data")
    place = {"city": "X", "state": "NY", "country": "US"}

    def user(n, registered):
        return {"user_id": f"user_{n:06d}", "geo_data": place, "registration_date": registered,
                "last_active": registered}

    def session(sid, n, start, seconds, status, views):
        return {
            "session_id": sid, "user_id": f"user_{n:06d}", "start_time": start, "end_time": start,
            "duration_seconds": seconds, "geo_data": {**place, "ip_address": "10.0.0.1"},
            "device_profile": {"type": "mobile", "os": "iOS", "browser": "Safari"},
            "viewed_products": ["prod_00001"], "cart_contents": {"prod_00001": {"quantity": 1, "price": 2.5}},
            "page_views": [{"timestamp": start, "page_type": "home", "product_id": None,
                            "category_id": None, "view_duration": 3}] * views,
            "conversion_status": status, "referrer": "direct",
        }

    def order(tid, n, when, quantity):
        item = {"product_id": "prod_00001", "quantity": quantity, "unit_price": 2.5, "subtotal": 2.5 * quantity}
        return {"transaction_id": tid, "session_id": None, "user_id": f"user_{n:06d}", "timestamp": when,
                "items": [item], "subtotal": 2.5 * quantity, "discount": 0, "total": 2.5 * quantity,
                "payment_method": "paypal", "status": "completed"}

    entities = {
        "users": [user(1, "2025-01-01T00:00:00"), user(2, "2025-01-31T00:00:00")],
        "categories": [{"category_id": "cat_001", "name": "One", "subcategories": [
            {"subcategory_id": f"sub_001_0{i}", "name": f"n{i}", "profit_margin": 0.1} for i in (0, 1)]}],
        "products": [{"product_id": "prod_00001", "name": "Thing", "category_id": "cat_001", "base_price": 2.5,
                      "current_stock": 3, "is_active": True, "creation_date": "2025-01-01T00:00:00",
                      "price_history": [{"price": 2.5, "date": "2025-01-01T00:00:00"}]}],
        "transactions": [order("t1", 1, "2025-03-01T10:00:00", 2), order("t2", 1, "2025-03-02T10:00:00", 4)],
    }
    for name, records in entities.items():
        (folder / f"{name}.json").write_text(json.dumps(records))
    (folder / "sessions").mkdir()
    chunks = [
        [session("s1", 1, "2025-03-01T00:00:00", 60, "browsed", 1),
         session("s2", 1, "2025-03-05T00:00:01.5", 600, "converted", 2)],
        [session("s3", 1, "2025-03-31T00:00:00", 3000, "abandoned", 1),
         session("s4", 2, "2025-03-31T00:00:01", 10, "browsed", 1)],
    ]
    for i, chunk in enumerate(chunks):
        (folder / "sessions" / f"sessions_{i}.json").write_text(json.dumps(chunk))
    return reports.EntityFolder(spark, str(folder))


def test_documents(spark, data, tmp_path):
    out = str(tmp_path / "docs")
    reports.load_documents(data, out)
    summary = {r.user_id: tuple(r.summary) for r in spark.read.parquet(f"{out}/users").collect()}
    assert summary == {"user_000001": (2, 7.5), "user_000002": (0, 0.0)}
    assert spark.read.parquet(f"{out}/products").first().category.subcategory_name == "n1"
    filled = spark.read.parquet(f"{out}/transactions").first()
    assert (filled.discount, filled.session_id) == (0.0, "none")


def test_lifetime_values_from_files_and_from_cells_agree(spark, data, tmp_path):
    table = str(tmp_path / "sessions_table")
    reports.load_session_rows(data, table)
    span = ("2025-03-01", "2025-03-31")
    direct = reports.lifetime_values(data, *span, "2025-03-02")
    stored = reports.lifetime_values(data, *span, "2025-03-02", cell_table=table)
    assert direct.collect() == stored.collect()
    first = stored.first()
    assert (first.user_id, first.session_count, first.total_duration) == ("user_000001", 2, 3600)
    assert first.clv == 7.5 * 2 * (2 / (60 / 30.0) / 10.0 + 1.0)
    assert [r.user_id for r in reports.top_customers(stored, 1).collect()] == ["user_000001"]
    out = tmp_path / "clv"
    reports.export_lifetime_values(stored, str(out), single_file=True)
    (file,) = out.glob("*.csv")
    assert file.read_text().splitlines()[0] == ",".join(customers.CLV_COLUMNS)


def test_a_row_with_a_bad_or_missing_duration_counts(spark, data, tmp_path):
    table = str(tmp_path / "sessions_table")
    reports.load_session_rows(data, table, F.lit(1))
    stored = read_cells(spark, table)
    broken = stored.filter("not (qualifier = 'duration' and value = '3000')").withColumn(
        "value", F.when(F.col("value") == "600", "abc").otherwise(F.col("value"))
    )
    got = cells.engagement_from_cells(data.users, broken, "2025-03-01", "2025-03-31")
    assert sorted(tuple(r) for r in got.collect()) == [("user_000001", 2, 0), ("user_000002", 0, 0)]


def test_published_metrics(spark, data, tmp_path):
    out = str(tmp_path / "metrics")
    reports.publish_metrics(data, out, F.lit(1))
    reports.publish_metrics(data, out, F.lit(2))

    def table(name):
        kept = cells.latest_cells(read_cells(spark, f"{out}/{name}"))
        return {(r.row_key, f"{r.family}:{r.qualifier}"): (r.value, r.version) for r in kept.collect()}

    assert table("sales_by_category") == {("cat_001", "revenue:total"): ("15.0", 2)}
    assert table("revenue_by_state") == {("NY", "revenue:total"): ("15.0", 2)}
    assert table("user_segmentation") == {
        ("0", "metrics:user_count"): ("1", 2), ("2", "metrics:user_count"): ("1", 2),
    }
    assert table("funnel_metrics")["browsed", "metrics:count"] == ("2", 2)
    assert table("sales_over_time")["2025-03-01 00:00:00", "revenue:total"] == ("5.0", 2)


def test_later_writes_win_and_compaction_keeps_three(spark, data, tmp_path):
    table, out = str(tmp_path / "rows"), str(tmp_path / "compact")
    for _ in range(4):
        reports.load_session_rows(data, table)
    stored = read_cells(spark, table)
    newest = stored.agg(F.max("version")).first()[0]
    assert {r.version for r in cells.latest_cells(stored).select("version").distinct().collect()} == {newest}
    reports.compact(spark, table, out)
    kept = read_cells(spark, out)
    assert kept.count() == stored.count() * 3 // 4
    assert sorted(map(tuple, cells.latest_cells(kept).collect())) == sorted(map(tuple, cells.latest_cells(stored).collect()))
