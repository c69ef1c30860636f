"""The named queries on tables where a third of all rows share one key.

With a low bound on group size the heavy groups take the cut path, and the
results must still be those of the SQL.
"""

import contextlib
import io
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from shopwright.operators.ordered import GROUP_ROWS_CONF, heavy_groups
from shopwright.operators.sessions import assign_sessions
from tests.test_queries import canonical

duckdb = pytest.importorskip("duckdb")

SOURCE = os.environ.get("SKEW_SF_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(SOURCE), reason="no test tables")

CUT_QUERIES = [
    "transactions_nested",
    "explode_items",
    "lookup_products_nested",
    "price_timeline",
    "session_rollup",
    "session_paths",
    "viewed_products",
    "view_durations",
    "view_category",
    "cart_contents",
    "conversion_funnel",
    "page_transitions",
    "session_cells",
    "latest_cells",
    "retained_versions",
    "stock_depletion",
    "filled_demands",
    "price_history_nested",
    "checkout_sessions",
    "price_summary",
    "engagement_from_cells",
    "clv_current",
    "revenue_by_category_order_total",
    "revenue_by_state",
    "user_summary",
]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Tables with user 7, product 7 and order 7 each in a third of their rows."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    read = lambda n: spark.read.parquet(f"{SOURCE}/{n}.parquet")
    third = lambda key, n: F.when(F.pmod(F.xxhash64(key, F.lit(n)), F.lit(3)) == 0, 7)
    pick = lambda key, column: third(key, 1).otherwise(F.col(column)).cast("bigint")
    tables = {n: read(n) for n in ("nation", "region", "customer", "part")}
    tables["orders"] = read("orders").withColumn("o_custkey", pick("o_orderkey", "o_custkey"))
    hot = F.when(third("event_id", 2).isNotNull(), '{"k": 7}').otherwise(F.col("props"))
    tables["events"] = (
        read("events").withColumn("props", hot).withColumn("user_id", pick("event_id", "user_id"))
    )
    lines = read("lineitem").withColumn("l_partkey", pick("l_extendedprice", "l_partkey"))
    tables["lineitem"] = lines.withColumn(
        "l_orderkey",
        F.when(F.pmod(F.xxhash64("l_suppkey", "l_extendedprice"), F.lit(3)) == 0, 7)
        .otherwise(F.col("l_orderkey"))
        .cast("bigint"),
    )
    con = duckdb.connect()
    for name, df in tables.items():
        df.repartition(4).write.parquet(f"{folder}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    return folder, con


@pytest.fixture
def low_bound(spark):
    spark.conf.set(GROUP_ROWS_CONF, "200")
    yield
    spark.conf.unset(GROUP_ROWS_CONF)


def test_heavy_groups_are_found(spark, skewed, low_bound):
    folder, _ = skewed
    events = spark.read.parquet(f"{folder}/events.parquet")
    heavy = heavy_groups(events, ["user_id"])
    assert [r[0] for r in events.filter(heavy).select("user_id").distinct().collect()] == [7]
    spark.conf.set(GROUP_ROWS_CONF, "1000000")
    assert heavy_groups(events, ["user_id"]) is None


@pytest.mark.parametrize("name", CUT_QUERIES)
def test_skewed_query_matches_sql(spark, skewed, low_bound, name):
    folder, db = skewed
    got = entry.queries()[name](spark, folder)
    columns = sorted(got.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = db.execute(f"SELECT {quoted} FROM ({entry.oracle_sql()[name]})").fetchall()
    rows = [tuple(r) for r in got.select(*[f"`{c}`" for c in columns]).collect()]
    assert len(rows) == len(want)
    assert canonical(rows) == canonical(want)


@pytest.fixture
def no_broadcast(spark):
    """Joins too large to broadcast, and sizes at which a third of these tables counts as skewed."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": "256KB",
        "spark.sql.files.openCostInBytes": "256KB",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    yield
    for key in small:
        spark.conf.unset(key)


def run_and_explain(df):
    rows = [tuple(r) for r in df.collect()]
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return rows, text.getvalue()


@pytest.mark.parametrize(
    "name", ["view_category", "lookup_products_nested", "revenue_by_category_order_total"]
)
def test_joins_split_a_hot_key(spark, skewed, no_broadcast, name):
    folder, db = skewed
    got = entry.queries()[name](spark, folder)
    columns = sorted(got.columns)
    rows, text = run_and_explain(got.select(*[f"`{c}`" for c in columns]))
    assert "skew=true" in text
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = db.execute(f"SELECT {quoted} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert canonical(rows) == canonical(want)


def test_a_busy_user_is_not_sent_to_one_task(spark, skewed, no_broadcast):
    folder, _ = skewed
    events = spark.read.parquet(f"{folder}/events.parquet").select("event_id", "user_id", "ts")
    plain, _ = run_and_explain(assign_sessions(events, "event_id", heavy=None))
    cut, text = run_and_explain(assign_sessions(events, "event_id", heavy=F.col("user_id") == 7))
    assert sorted(plain) == sorted(cut)
    assert "hashpartitioning(user_id" in text
    final = text[: text.index("== Initial Plan ==")]
    shuffles = [x for x in final[final.index("SortMergeJoin") :].splitlines() if "hashpartitioning" in x]
    assert shuffles and all("slot" in x for x in shuffles)
