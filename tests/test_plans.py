"""Properties of the physical plans that matter at scale."""

import contextlib
import io
import os
import re

import pytest

import __spark_entry__ as entry
from shopwright.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

WRITING = {
    "csv_export", "json_export", "append_table", "ensure_table",
    "session_cells_in_range", "engagement_from_cells",
}


def plan(spark, name):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        entry.queries()[name](spark, FOLDER).explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(spark, name)
    for banned in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD"):
        assert banned not in text


@pytest.mark.parametrize("name", ["top_products", "revenue_by_state", "clv_top10", "first_n_users"])
def test_top_k_is_not_a_full_sort(spark, name):
    assert "TakeOrderedAndProject" in plan(spark, name)


def test_only_needed_columns_are_read(spark):
    text = plan(spark, "top_products")
    (schema,) = re.findall(r"ReadSchema: struct<(.*)>", text)
    assert {c.split(":")[0] for c in schema.split(",")} == {"l_partkey", "l_quantity", "l_extendedprice"}


def test_user_lookup_filters_in_the_scan(spark):
    text = plan(spark, "user_sessions_range")
    assert "EqualTo(user_id,42)" in text


def test_key_range_filters_in_the_scan(spark):
    text = plan(spark, "session_cells_in_range")
    assert "GreaterThanOrEqual(row_key,user_000042:" in text
    assert "LessThan(row_key,user_000042:" in text


def test_newest_versions_are_limited_before_the_shuffle(spark):
    text = plan(spark, "retained_versions")
    assert text.count("WindowGroupLimit") >= 2


def test_items_are_summed_before_the_join(spark):
    text = plan(spark, "revenue_by_category")
    tree = text[: text.index("(1)")] if "(1)" in text else text
    assert tree.index("BroadcastHashJoin") < tree.rindex("HashAggregate")


def test_transitions_shuffle_events_once(spark):
    text = plan(spark, "page_transitions")
    keys = re.findall(r"Arguments: hashpartitioning\(([^)]*)\)", text)
    assert len(keys) == 3 and keys[0].startswith("user_id")


@pytest.mark.parametrize("name", ["user_engagement", "sessions_in_range", "clv_current", "clv_hours_only", "clv_top10"])
def test_range_queries_push_the_time_into_the_scan(spark, name):
    assert "GreaterThanOrEqual(ts," in plan(spark, name)


@pytest.mark.parametrize(("name", "table", "scans"), [("clv_current", "orders", 1), ("metric_cells", "lineitem", 0)])
def test_a_table_is_scanned_once(spark, name, table, scans):
    """The items of metric_cells are summed into a stored table, in one scan of their own."""
    text = plan(spark, name)
    assert len(re.findall(rf"Location: InMemoryFileIndex \[[^\]]*/{table}.parquet", text)) == scans


def test_engagement_reads_only_session_data(spark):
    assert "EqualTo(family,session_data)" in plan(spark, "engagement_from_cells")


def test_queries_leave_the_session_time_zone_alone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        entry.queries()["daily_sales"](spark, FOLDER)
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_stock_queues_are_cut_before_the_shuffle_by_product(spark):
    """The greatest stock bounds the turns, below every exchange on product_id alone."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        entry.queries()["stock_depletion"](spark, FOLDER).explain()
    lines = text.getvalue().splitlines()
    cut = next(i for i, line in enumerate(lines) if re.search(r"Filter .* \* quantity.* <= Subquery", line))
    depth = len(lines[cut]) - len(lines[cut].lstrip(" :+-"))
    above = [line for line in lines[:cut] if len(line) - len(line.lstrip(" :+-")) < depth]
    assert not any("hashpartitioning(product_id" in line and "quantity" in line for line in above)
    assert any("collect_list" in line for line in above)
