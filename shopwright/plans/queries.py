"""Every operator as a named query: (spark, folder of tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopwright import sinks
from shopwright.sinks import keyed
from shopwright.functions import (
    add_seconds,
    amount,
    epoch_micros,
    iso_text,
    map_value,
    money_sum,
    padded_id,
    row_key,
    subcategory_id,
    title_case,
)
from shopwright.operators import catalog, cells, customers, inventory, sales
from shopwright.operators import sessions as S
from shopwright.operators.numbering import numbered
from shopwright.operators.nesting import gathered, nest, unnest
from shopwright.operators.ordered import heavy_groups
from shopwright.shared import discard_at_end, new_folder, stored
from shopwright.sources import warehouse as W
from shopwright.sources.entities import read_cells, read_checked, read_entity, register_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

AS_OF = "2024-02-01"
RANGE = ("2024-01-05 00:00:00", "2024-01-25 00:00:00")
LOOKUP_USER = 42
LOOKUP_RANGE = ("2024-01-05 00:00:00", "2024-01-15 00:00:00")


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        # Zone-less times are read as UTC. Expressions take up the zone when they are made,
        # so the session gets its own one back.
        zone = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        try:
            return fn(spark, folder)
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)

    QUERIES[fn.__name__] = run
    return run


def _busy_users(spark, folder):
    """Users with a heavy share of the events, found once and used for all that follows."""
    return heavy_groups(W.table(spark, folder, "events").select("user_id"), ["user_id"])


# --- sales -----------------------------------------------------------------


@query
def top_products(spark, folder):
    return sales.top_products(W.items(spark, folder))


@query
def revenue_by_category(spark, folder):
    return sales.revenue_by_category(W.items(spark, folder), W.products(spark, folder))


@query
def revenue_by_category_order_total(spark, folder):
    orders = W.transactions(spark, folder).select("transaction_id", "total")
    lines = W.items(spark, folder).select("transaction_id", "product_id")
    return sales.revenue_by_category_order_total(
        lines.join(orders, "transaction_id"), W.products(spark, folder)
    )


@query
def lookup_products_nested(spark, folder):
    looked_up = sales.lookup_products(
        W.items(spark, folder), W.products(spark, folder), ["name", "category_id", "base_price"]
    )
    return looked_up.select(
        "transaction_id",
        "line",
        "product_id",
        "quantity",
        "subtotal",
        F.size("product_info").alias("matches"),
        F.get("product_info", F.lit(0))["category_id"].alias("category_id"),
    )


@query
def revenue_by_state(spark, folder):
    return sales.revenue_by_state(W.users(spark, folder), W.transactions(spark, folder))


@query
def revenue_by_state_sql(spark, folder):
    register_views(users=W.users(spark, folder), transactions=W.transactions(spark, folder))
    return spark.sql(
        """
        SELECT state, CAST(sum(spend) AS DOUBLE) AS total_revenue
        FROM (SELECT user_id, geo_data.state AS state FROM users) u
        JOIN (SELECT user_id, sum(CAST(total AS DECIMAL(18,2))) AS spend
              FROM transactions GROUP BY user_id) t USING (user_id)
        GROUP BY state ORDER BY sum(spend) DESC, state
        """
    )


@query
def daily_sales(spark, folder):
    return sales.daily_sales(W.transactions(spark, folder))


@query
def order_totals(spark, folder):
    totals = sales.order_totals(W.items(spark, folder), ["transaction_id"], F.max("discount_rate"))
    amounts = ("subtotal", "discount", "total")
    return totals.withColumns({c: F.col(c).cast("double") for c in amounts})


def _nested(spark, folder):
    return sales.nest_transactions(
        W.transactions(spark, folder),
        W.items(spark, folder),
        "transaction_id",
        W.ITEM_ORDER,
        ["product_id", "quantity", "subtotal"],
    )


@query
def transactions_nested(spark, folder):
    lines = F.transform(
        "items", lambda i: F.concat_ws("x", i["product_id"].cast("string"), i["quantity"].cast("string"))
    )
    whole = gathered(_nested(spark, folder), ["transaction_id", "user_id", "total"], "items")
    return whole.select(
        "transaction_id",
        "user_id",
        "total",
        F.size("items").alias("n_items"),
        F.array_join(lines, " ").alias("item_list"),
    )


@query
def explode_items(spark, folder):
    return sales.explode_items(_nested(spark, folder)).select(
        "transaction_id", "user_id", "product_id", "quantity", "subtotal"
    )


@query
def null_defaults(spark, folder):
    seen = W.events(spark, folder).groupBy("user_id").agg(
        F.count("*").alias("events"),
        F.max_by("page_type", F.struct("ts", "event_id")).alias("last_page"),
        F.max("value").alias("top_value"),
    )
    joined = W.user_ids(spark, folder).join(seen, "user_id", "left")
    return sales.fill_defaults(joined, {"events": 0, "last_page": "none", "top_value": 0.0})


# --- catalogue ---------------------------------------------------------------


@query
def product_catalog(spark, folder):
    return catalog.product_catalog(W.products(spark, folder), W.categories(spark, folder)).select(
        "product_id",
        "name",
        F.col("category.category_id").alias("category_id"),
        F.col("category.name").alias("category_name"),
        F.col("category.subcategory_id").alias("subcategory_id"),
        F.col("category.subcategory_name").alias("subcategory_name"),
    )


@query
def category_tree(spark, folder):
    return W.categories(spark, folder).select(
        "category_id", F.col("name").alias("category_name"), F.inline("subcategories")
    )


@query
def price_timeline(spark, folder):
    return catalog.price_timeline(W.price_changes(spark, folder))


@query
def price_summary(spark, folder):
    return catalog.price_summary(W.price_changes(spark, folder))


@query
def price_history_nested(spark, folder):
    """Price lists nested per product in price order, then put in order of date."""
    listed = nest(
        W.price_changes(spark, folder), ["product_id"], ["price", "date"], ["price", "date"], "price_history"
    )
    # Read several times from here on.
    return _price_facts(catalog.sort_price_history(stored(listed, "price-lists")))


def _price_facts(products):
    """One row per product, whatever number of parts its list has; only the parts' texts are put together."""
    keys = ["product_id", "base_price", "current_price", "creation_date"]
    floors = F.transform("price_history", lambda h: F.floor(h["price"]).cast("string"))
    # A part without any price gives no text, so that it gives no blank either.
    text = F.when(F.exists(floors, lambda p: p.isNotNull()), F.array_join(floors, " "))
    piece = F.struct(F.size("price_history").alias("changes"), text.alias("prices"))
    prices = gathered(products.select(*keys, "part", F.array(piece).alias("pieces")), keys, "pieces")
    return prices.select(
        "product_id",
        F.aggregate("pieces", F.lit(0), lambda n, p: n + p["changes"]).alias("changes"),
        "base_price",
        "current_price",
        "creation_date",
        F.array_join("pieces.prices", " ").alias("prices"),
    )


@query
def price_history_by_category(spark, folder):
    """The prices of whole categories as one list each: lists of more than one part."""
    goods = W.products(spark, folder).select("product_id", F.col("category_id").alias("category"))
    changes = W.price_changes(spark, folder).join(goods, "product_id")
    changes = changes.select(F.col("category").alias("product_id"), "date", "price")
    listed = nest(changes, ["product_id"], ["price", "date"], ["price", "date"], "price_history", part_rows=100)
    prices = _price_facts(catalog.sort_price_history(stored(listed, "price-lists"), part_rows=100))
    return prices.withColumnRenamed("product_id", "category_id")


@query
def purchasable_products(spark, folder):
    goods = W.products(spark, folder)
    left = _stock(spark, folder).select("product_id", "remaining_stock")
    stocked = goods.drop("current_stock").join(
        left.withColumnRenamed("remaining_stock", "current_stock"), "product_id"
    )
    return catalog.purchasable_products(stocked).select(
        "product_id", "name", "category_id", "current_stock"
    )


# --- sessions ----------------------------------------------------------------


@query
def session_rollup(spark, folder):
    return W.sessions(spark, folder).select(
        W.session_label().alias("session_id"),
        "user_id",
        "start_time",
        "end_time",
        "duration_seconds",
        "views",
    )


@query
def session_paths(spark, folder):
    heavy = _busy_users(spark, folder)
    nested = S.session_paths(
        W.page_views(spark, folder, heavy),
        W.SESSION_KEYS,
        W.VIEW_ORDER,
        ["ts", "page_type", "product_id"],
        heavy=heavy,
    )
    return gathered(nested, W.SESSION_KEYS, "page_views").select(
        W.session_label().alias("session_id"),
        F.size("page_views").alias("views"),
        F.array_join(F.transform("page_views", lambda v: v["page_type"]), ">").alias("path"),
    )


@query
def checkout_sessions(spark, folder):
    """Whether a nested session has a purchase page, over all its parts."""
    heavy = _busy_users(spark, folder)
    nested = S.session_paths(
        W.page_views(spark, folder, heavy), W.SESSION_KEYS, W.VIEW_ORDER, ["page_type"], heavy=heavy
    )
    reached = F.max(S.reached_checkout(pages=["purchase"]))
    return nested.groupBy(*W.SESSION_KEYS).agg(reached.alias("reached")).select(
        W.session_label().alias("session_id"), "reached"
    )


@query
def viewed_products(spark, folder):
    heavy = _busy_users(spark, folder)
    nested = S.viewed_products(W.page_views(spark, folder, heavy), W.SESSION_KEYS)
    return nested.select(
        W.session_label().alias("session_id"),
        F.size("viewed_products").alias("products"),
        F.array_join("viewed_products", ",").alias("product_list"),
    )


@query
def view_durations(spark, folder):
    heavy = _busy_users(spark, folder)
    timed = S.view_durations(
        W.page_views(spark, folder, heavy), W.SESSION_KEYS, W.VIEW_ORDER, "session_end", heavy=heavy
    )
    return timed.select("event_id", "user_id", "page_type", "ts", "view_duration")


@query
def view_category(spark, folder):
    return S.view_category(W.events(spark, folder), W.products(spark, folder)).select(
        "event_id", "user_id", "product_id", "category_id"
    )


@query
def cart_contents(spark, folder):
    heavy = _busy_users(spark, folder)
    adds = W.cart_adds(W.page_views(spark, folder, heavy))
    entries = S.cart_entries(adds, W.SESSION_KEYS, W.VIEW_ORDER)
    carts = S.cart_contents(entries, W.SESSION_KEYS)
    return carts.select(
        W.session_label().alias("session_id"), F.explode("cart_contents").alias("product_id", "line")
    ).select("session_id", "product_id", "line.quantity", "line.price")


@query
def session_conversion(spark, folder):
    return W.sessions(spark, folder).select(
        W.session_label().alias("session_id"), "user_id", "conversion_status"
    )


@query
def conversion_funnel(spark, folder):
    return S.conversion_funnel(W.sessions(spark, folder))


@query
def page_transitions(spark, folder):
    heavy = _busy_users(spark, folder)
    views = W.page_views(spark, folder, heavy)
    return S.page_transitions(views, W.SESSION_KEYS, W.VIEW_ORDER, heavy=heavy)


@query
def user_sessions_range(spark, folder):
    found = S.user_sessions(W.sessions(spark, folder), LOOKUP_USER, *LOOKUP_RANGE, tie=["session_no"])
    return found.select(
        row_key(W.user_label(), "start_time").alias("row_key"),
        "start_time",
        "duration_seconds",
        "views",
        "conversion_status",
    )


@query
def sessions_in_range(spark, folder):
    return S.sessions_in_range(W.session_spans(spark, folder, RANGE[0]), *RANGE).select(
        row_key(W.user_label(), "start_time").alias("row_key"), "start_time", "duration_seconds"
    )


# --- customers ---------------------------------------------------------------


@query
def user_purchases(spark, folder):
    return customers.purchase_totals(W.transactions(spark, folder))


def _summaries(spark, folder):
    return customers.user_summary(W.user_ids(spark, folder), W.transactions(spark, folder))


@query
def user_summary(spark, folder):
    return _summaries(spark, folder).select(
        "user_id",
        F.col("summary.total_purchases").alias("total_purchases"),
        F.col("summary.avg_spend").alias("avg_spend"),
    )


@query
def purchase_segments(spark, folder):
    return customers.purchase_segments(_summaries(spark, folder))


@query
def distinct_users(spark, folder):
    return customers.distinct_users(W.transactions(spark, folder))


@query
def user_engagement(spark, folder):
    return customers.engagement(W.user_ids(spark, folder), W.session_spans(spark, folder, RANGE[0]), *RANGE)


@query
def engagement_lenient(spark, folder):
    seconds = F.col("duration_seconds").cast("string")
    texts = W.session_spans(spark, folder).withColumn(
        "duration", F.when(F.col("session_no") % 7 == 0, F.concat(seconds, F.lit("s"))).otherwise(seconds)
    )
    return customers.engagement_totals(texts, "duration")


def _clv(spark, folder, mode):
    return customers.customer_lifetime_value(
        W.buyers(spark, folder),
        None,
        customers.engagement_totals(S.sessions_in_range(W.session_spans(spark, folder, RANGE[0]), *RANGE)),
        AS_OF,
        mode,
    )


@query
def clv_current(spark, folder):
    return _clv(spark, folder, "current")


@query
def clv_hours_only(spark, folder):
    return _clv(spark, folder, "hours_only")


@query
def clv_top10(spark, folder):
    return _clv(spark, folder, "current").limit(10)


@query
def first_n_users(spark, folder):
    return customers.first_n(W.people(spark, folder), ["user_id"], 1000).select("user_id", "name")


@query
def merge_update(spark, folder):
    """The status of each user's last order; users without orders keep their segment and balance."""
    last = W.transactions(spark, folder).groupBy("user_id").agg(
        F.max_by("status", F.struct("timestamp", "transaction_id")).alias("segment"), F.max("total").alias("balance")
    )
    return customers.merge_update(
        W.people(spark, folder), last, "user_id", ["segment", "balance"]
    ).select("user_id", "name", "segment", "balance")


def _user_ranges(spark, folder):
    """Two time ranges of each user's own, from a day to some weeks long, which may overlap."""
    day = F.lit("2024-01-01 00:00:00").cast("timestamp")
    own = [
        (F.col("user_id") % 15, 1 + F.col("user_id") % 20, F.col("user_id") % 24),
        (F.col("user_id") % 11, 3 + F.col("user_id") % 2, F.lit(0)),
    ]
    spans = []
    for first, days, hours in own:
        start = day + F.make_dt_interval(first.cast("int"))
        end = start + F.make_dt_interval(days.cast("int"), hours.cast("int"))
        spans.append(F.struct(start.alias("start"), end.alias("end")))
    return W.user_ids(spark, folder).select("user_id", F.inline(F.array(*spans)))


@query
def engagement_in_user_ranges(spark, folder):
    """Sessions that start in each user's own ranges."""
    return customers.engagement_in_ranges(_user_ranges(spark, folder), W.session_spans(spark, folder))


@query
def engagement_during_user_ranges(spark, folder):
    """Sessions of which any time lies in each user's own ranges."""
    return customers.engagement_in_ranges(
        _user_ranges(spark, folder), W.session_spans(spark, folder), during="end_time"
    )


@query
def clv_ranked(spark, folder):
    """Customers with their place by lifetime value; equal values share a rank."""
    ranked = numbered(_clv(spark, folder, "hours_only"), ["-clv"], ["user_id"], dense="dense")
    return ranked.select("user_id", "clv", "number", "rank", "dense")


@query
def purchase_ranks(spark, folder):
    """Customers by number of purchases, where very many are equal."""
    bought = _clv(spark, folder, "hours_only").select("user_id", "purchase_count")
    return numbered(bought, ["-purchase_count"], ["user_id"], dense="dense")


# --- cells -------------------------------------------------------------------


def _session_cells(spark, folder):
    heavy = _busy_users(spark, folder)
    views = W.page_views(spark, folder, heavy)
    numbered = S.view_durations(views, W.SESSION_KEYS, W.VIEW_ORDER, "session_end", position="seq", heavy=heavy)
    # The session row comes from the same rows as the page-view cells.
    documents = (
        W.session_documents(views)
        .join(W.users(spark, folder).select("user_id", "geo_data"), "user_id", "left")
        .withColumns(
            {
                "device_profile": F.lit(None).cast("struct<type:string,os:string,browser:string>"),
                "session_id": W.session_label(),
            }
        )
        .withColumn("user_id", W.user_label())
    )
    flat = S.view_category(numbered, W.products(spark, folder)).select(
        W.session_label().alias("session_id"),
        W.user_label().alias("user_id"),
        F.col("session_start").alias("start_time"),
        (F.col("seq") - 1).alias("pv"),
        F.col("ts").alias("timestamp"),
        "page_type",
        "product_id",
        "category_id",
        "view_duration",
    )
    return cells.session_cells(documents, F.lit(0), flat)


@query
def session_cells(spark, folder):
    return _session_cells(spark, folder)


@query
def session_cells_in_range(spark, folder):
    """Session rows written as a cell table and read back by key range."""
    path = new_folder(spark, "cells")
    sinks.write_cells(_session_cells(spark, folder), path)
    discard_at_end(spark, path)
    return cells.rows_of_user(read_cells(spark, path), f"user_{LOOKUP_USER:06d}", *LOOKUP_RANGE)


@query
def engagement_from_cells(spark, folder):
    """Session rows stored as cells, then read by key for all users."""
    people = W.user_ids(spark, folder).select(W.user_label().alias("user_id"))
    path = new_folder(spark, "cells")
    sinks.write_cells(_session_cells(spark, folder), path)
    discard_at_end(spark, path)
    return cells.engagement_from_cells(people, read_cells(spark, path), *RANGE)


def _colliding(spark, folder):
    """One row key per user and day with a cell for what each event says, written three times over.

    Several events meet under one key in one write; a later write changes the values.
    """
    views = W.events(spark, folder).withColumn("day", F.date_trunc("day", F.col("ts").cast("timestamp")))
    named = F.array(
        F.struct(F.lit("event").alias("qualifier"), F.col("event_id").cast("string").alias("value")),
        F.struct(F.lit("page").alias("qualifier"), F.col("page_type").alias("value")),
    )
    writes = F.explode(F.array(*(F.lit(i).cast("bigint") for i in range(3)))).alias("version")
    rows = views.select("*", writes).filter((F.col("version") == 0) | (F.col("event_id") % (F.col("version") + 1) == 0))
    put = F.concat(F.lpad(epoch_micros("ts").cast("string"), 19, "0"), F.lit(":"), F.lpad(F.col("event_id").cast("string"), 12, "0"))
    key = row_key(W.user_label(), "day")
    return rows.select(key.alias("row_key"), F.lit("seen").alias("family"), F.inline(named), "version", put.alias("put"))


@query
def wide_rows(spark, folder):
    """The newest cells as one row per key: both cells always come from one put."""
    return cells.wide_rows(_colliding(spark, folder)).select(
        "row_key",
        map_value("cells", "seen:event", "").alias("event"),
        map_value("cells", "seen:page", "").alias("page"),
    )


def _keyed(spark, df, key, buckets=8):
    """An empty table by key, cut where this data's keys are."""
    path = new_folder(spark, "keyed")
    splits = keyed.split_points(df.select(key), 16)
    discard_at_end(spark, path)
    return keyed.create(spark, "keyed_" + path.rsplit("-", 1)[1], path, df.schema, key, splits, buckets)


@query
def wide_rows_of_runs(spark, folder):
    """Three loads kept as sorted runs, two of them merged, and then read as one row per key."""
    writes = stored(_colliding(spark, folder), "writes")
    table = _keyed(spark, writes, "row_key")
    for version in range(3):
        keyed.add_run(writes.filter(F.col("version") == version), table)
        if version == 1:
            keyed.compact_cells(table, versions=1)
    return cells.wide_rows(table.rows()).select(
        "row_key",
        map_value("cells", "seen:event", "").alias("event"),
        map_value("cells", "seen:page", "").alias("page"),
    )


@query
def upserted_orders(spark, folder):
    """Orders of half the customers, and then a third of all orders put over them, twice."""
    orders = W.transactions(spark, folder).select(
        "transaction_id", padded_id("order_", 10, "transaction_id").alias("order_key"), "user_id", "status", "total"
    )
    table = _keyed(spark, orders, "order_key")
    keyed.add_run(orders.filter(F.col("user_id") % 2 == 0), table)
    checked = orders.filter(F.col("transaction_id") % 3 == 0).withColumn("status", F.lit("checked"))
    for _ in range(2):
        keyed.upsert(checked, table)
    return table.rows().drop(keyed.RANGE)


@query
def folded_summaries(spark, folder):
    """Purchase summaries kept up to date over three batches of orders."""
    orders = W.transactions(spark, folder).withColumn("user_key", W.user_label())
    last = F.struct("timestamp", "transaction_id")
    state = {"n": F.count("*"), "spend": money_sum("total").cast("decimal(38,6)"), "last": F.max(last)}
    table = None
    for batch in range(3):
        made = orders.filter(F.col("transaction_id") % 3 == batch).groupBy("user_key").agg(
            *(how.alias(c) for c, how in state.items())
        )
        table = table or _keyed(spark, made, "user_key")
        merge = {"n": F.sum("n"), "spend": F.sum("spend").cast("decimal(38,6)"), "last": F.max("last")}
        keyed.fold(made, table, merge)
    return table.rows().select("user_key", "n", amount("spend").alias("spend"), F.col("last.transaction_id").alias("last_order"))


def _versioned(spark, folder):
    return W.events(spark, folder).select(
        W.user_label().alias("row_key"),
        F.lit("metrics").alias("family"),
        F.col("page_type").alias("qualifier"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("value"),
        epoch_micros("ts").alias("version"),
        F.lit("").alias("put"),
    )


@query
def latest_cells(spark, folder):
    return cells.latest_cells(_versioned(spark, folder)).drop("put")


@query
def retained_versions(spark, folder):
    return cells.retain_versions(_versioned(spark, folder), 3).drop("put")


@query
def metric_cells(spark, folder):
    """The six published metrics in one table."""
    orders = W.transactions(spark, folder)
    lines = W.items(spark, folder).join(orders.select("transaction_id", "total"), "transaction_id", "left")
    # One pass over the items gives what three metrics need, a row per product; it is stored
    # because each of them would otherwise prune and scan for itself.
    sold = stored(sales.product_totals(lines), "sold")
    kinds = sales.category_totals(sold, W.products(spark, folder))
    top = sold.orderBy(F.desc("revenue"), "product_id").limit(10).select("product_id", amount("revenue").alias("total_revenue"))
    revenue = ("total_revenue", "revenue", "total")
    published = {
        "products_metrics": (top, "product_id", *revenue),
        "sales_by_category": (
            kinds.select("category_id", amount("order_revenue").alias("total_revenue")), "category_id", *revenue,
        ),
        "revenue_by_category": (
            kinds.select("category_id", amount("revenue").alias("total_revenue")), "category_id", *revenue,
        ),
        "sales_over_time": (sales.daily_sales(orders), "day", *revenue),
        "funnel_metrics": (
            S.conversion_funnel(W.sessions(spark, folder)), "conversion_status", "count", "metrics", "count",
        ),
        "user_segmentation": (
            customers.purchase_segments(_summaries(spark, folder)),
            "purchase_count", "user_count", "metrics", "user_count",
        ),
    }
    tables = [
        cells.metric_cells(*spec, F.lit(0)).withColumn("metric", F.lit(name)) for name, spec in published.items()
    ]
    return reduce(DataFrame.unionByName, tables).drop("version", "put")


# --- documents written and read -------------------------------------------------


def _entity(spark, name, df):
    """A table written as JSON and read back with the entity's fixed schema."""
    path = new_folder(spark, name)
    sinks.write_json(df, path)
    discard_at_end(spark, path)
    return read_entity(spark, name, path)


@query
def users_from_json(spark, folder):
    made = W.users(spark, folder).select(W.user_label().alias("user_id"), "geo_data")
    return _entity(spark, "users", made).select(
        "user_id", F.col("geo_data.state").alias("state"), F.col("geo_data.country").alias("country")
    )


@query
def checked_users(spark, folder):
    """Users read from JSON Lines of which every seventh is cut off and every eleventh has a text for its address."""
    made = W.users(spark, folder).select(W.user_label().alias("user_id"), "geo_data", F.col("user_id").alias("number"))
    line = F.to_json(F.struct("user_id", "geo_data"))
    broken = (
        F.when(F.col("number") % 7 == 0, F.substring(line, 1, 30))
        .when(F.col("number") % 11 == 0, F.to_json(F.struct("user_id", F.lit("nowhere").alias("geo_data"))))
        .otherwise(line)
    )
    path = new_folder(spark, "users")
    made.select(broken.alias("value")).write.mode("overwrite").format("text").save(f"{path}/lines.json")
    discard_at_end(spark, path)
    good, bad = read_checked(spark, "users", f"{path}/lines.json")
    counted = [
        df.agg(F.lit(kind).alias("kind"), F.count("*").alias("records"), F.count_distinct(*keys).alias("different"))
        for kind, df, keys in (("good", good, ["user_id", "geo_data.state"]), ("bad", bad, ["record"]))
    ]
    return counted[0].unionByName(counted[1])


@query
def catalog_from_json(spark, folder):
    """Products and categories as documents, each category stored twice."""
    kinds = W.categories(spark, folder)
    listed = nest(W.price_changes(spark, folder), ["product_id"], ["price", "date"], ["price", "date"], "price_history")
    goods = W.products(spark, folder).drop("base_price").join(listed, "product_id", "left")
    documents = _entity(spark, "products", goods.withColumn("product_id", F.col("product_id").cast("string")))
    kinds = _entity(spark, "categories", kinds.unionByName(kinds))
    return catalog.product_catalog(documents, kinds).select(
        "product_id", "name", "category.category_id", F.col("category.subcategory_id").alias("subcategory_id"),
        F.size("price_history").alias("changes"),
    )


@query
def transactions_from_json(spark, folder):
    """Orders with nested items as documents, back as numbered items."""
    items = W.items(spark, folder).select(
        "transaction_id", "line", F.col("product_id").cast("string").alias("product_id"), "quantity", "subtotal"
    )
    fields = ["product_id", "quantity", "subtotal"]
    nested = nest(items, ["transaction_id"], ["line", *fields], fields, "items")
    nested = gathered(nested, ["transaction_id"], "items")
    made = W.transactions(spark, folder).join(nested, "transaction_id").select(
        F.col("transaction_id").cast("string").alias("transaction_id"), "total", "status", "items"
    )
    documents = _entity(spark, "transactions", made).drop("subtotal")
    return unnest(documents, "items", index="n").select(
        "transaction_id", "total", "status", "n", *fields
    )


def _session_documents(spark, folder):
    heavy = _busy_users(spark, folder)
    views = W.page_views(spark, folder, heavy)
    paths = S.view_durations(views, W.SESSION_KEYS, W.VIEW_ORDER, "session_end", heavy=heavy)
    fields = ["timestamp", "page_type", "product_id", "view_duration"]
    paths = paths.withColumn("timestamp", F.col("ts")).withColumn("product_id", F.col("product_id").cast("string"))
    paths = paths.withColumn("page_type", F.when(F.col("page_type") == "purchase", "checkout").otherwise(F.col("page_type")))
    paths = nest(paths, W.SESSION_KEYS, W.VIEW_ORDER, fields, "page_views", heavy=heavy)
    paths = gathered(paths, W.SESSION_KEYS, "page_views")
    entries = S.cart_entries(W.cart_adds(views), W.SESSION_KEYS, W.VIEW_ORDER)
    carts = S.cart_contents(entries.withColumn("product_id", F.col("product_id").cast("string")), W.SESSION_KEYS)
    made = W.session_documents(views).join(paths, W.SESSION_KEYS).join(carts, W.SESSION_KEYS, "left").select(
        W.session_label().alias("session_id"), W.user_label().alias("user_id"), "start_time", "end_time",
        "duration_seconds", F.transform("viewed_products", lambda p: p.cast("string")).alias("viewed_products"),
        "page_views", "cart_contents",
    )
    return _entity(spark, "sessions", made)


@query
def classified_sessions(spark, folder):
    """Session documents read from JSON and classified by pages and cart."""
    return S.classify_conversion(_session_documents(spark, folder)).select(
        "session_id", "conversion_status", F.size("page_views").alias("views")
    )


@query
def nested_session_cells(spark, folder):
    """Cells of session documents with nested page views."""
    made = cells.session_cells(_session_documents(spark, folder), F.lit(0))
    return made.filter("qualifier not in ('geo_data', 'device_profile', 'conversion_status')").select(
        "row_key", "family", "qualifier", "value"
    )


@query
def unassigned_events(spark, folder):
    """Events that no session can hold, and all others, by page type."""
    clicks = W.events(spark, folder)
    lost = S.unassigned_events(clicks).groupBy("page_type").agg(F.count("*").alias("lost"))
    every = clicks.groupBy("page_type").agg(F.count("*").alias("events"))
    return every.join(lost, "page_type", "left").select("page_type", "events", F.coalesce("lost", F.lit(0)).alias("lost"))


# --- inventory ---------------------------------------------------------------


def _stock(spark, folder):
    demands = W.items(spark, folder)
    return inventory.stock_depletion(
        W.products(spark, folder), demands, ["ship_date", "transaction_id", "line"]
    )


@query
def stock_depletion(spark, folder):
    return _stock(spark, folder)


@query
def filled_demands(spark, folder):
    filled = inventory.filled_demands(
        W.products(spark, folder), W.items(spark, folder), ["ship_date", "transaction_id", "line"]
    )
    return filled.select("transaction_id", "line", "product_id", "quantity", "ship_date")


@query
def remaining_stock(spark, folder):
    return inventory.remaining_stock(_stock(spark, folder), "remaining_stock")


# --- functions and formats -----------------------------------------------------


@query
def table_counts(spark, folder):
    names = ("customer", "part", "orders", "lineitem", "events", "nation", "region")
    counts = [
        W.table(spark, folder, n).agg(F.count("*").alias("rows")).select(F.lit(n).alias("name"), "rows")
        for n in names
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def text_functions(spark, folder):
    return W.products(spark, folder).select(
        "product_id",
        title_case("name").alias("title"),
        padded_id("prod_", 5, "product_id").alias("padded"),
        subcategory_id("category_id", 1).alias("subcategory"),
    )


@query
def time_functions(spark, folder):
    return W.events(spark, folder).select(
        "event_id",
        epoch_micros("ts").alias("micros"),
        iso_text("ts").alias("iso"),
        iso_text(add_seconds("ts", F.col("product_id").cast("int"))).alias("later"),
        row_key(W.user_label(), "ts").alias("row_key"),
        F.least(F.lit(3), F.floor(F.col("value") / 10).cast("int")).alias("take"),
    )


@query
def map_lookup(spark, folder):
    """Events of each type per user as a map, read with a default."""
    per_type = W.events(spark, folder).groupBy("user_id", "page_type").agg(F.count("*").alias("n"))
    # At most one entry per event type.
    maps = per_type.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("page_type", "n"))).alias("by_type")
    )
    return maps.select(
        "user_id",
        map_value("by_type", "purchase", 0).alias("purchases"),
        map_value("by_type", "refund", 0).alias("refunds"),
    )


@query
def json_roundtrip(spark, folder):
    read = W.table(spark, folder, "events").withColumn("obj", F.from_json("props", "k BIGINT"))
    return read.select("event_id", F.col("obj.k").alias("k"), F.to_json("obj").alias("json"))


@query
def csv_export(spark, folder):
    orders, path = W.transactions(spark, folder), new_folder(spark, "csv")
    sinks.export(orders, path, "csv")
    discard_at_end(spark, path)
    return spark.read.schema(orders.schema).option("header", True).csv(path)


@query
def json_export(spark, folder):
    orders, path = W.transactions(spark, folder), new_folder(spark, "json")
    sinks.export(orders, path, "json")
    discard_at_end(spark, path)
    return spark.read.schema(orders.schema).option("pathGlobFilter", "*.json").json(path)


@query
def append_table(spark, folder):
    orders, path = W.transactions(spark, folder), new_folder(spark, "appended")
    sinks.append(orders, path)
    sinks.append(orders, path)
    discard_at_end(spark, path)
    return spark.read.parquet(path)


@query
def ensure_table(spark, folder):
    orders, path = W.transactions(spark, folder), new_folder(spark, "table")
    name = "t_" + path.rsplit("-", 1)[-1]
    sinks.ensure_table(spark, name, orders.schema, path)
    sinks.ensure_table(spark, name, orders.schema, path)
    orders.write.insertInto(name)
    return spark.table(name)
