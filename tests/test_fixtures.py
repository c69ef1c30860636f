"""Hand-made rows per operator: nulls, empties, ties and boundaries."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from shopwright import sinks
from shopwright.functions import (
    add_seconds,
    iso_text,
    money,
    map_value,
    padded_id,
    row_key,
    subcategory_id,
    title_case,
)
from shopwright.operators import catalog, cells, customers, inventory, sales
from shopwright.operators import sessions as S
from shopwright.operators.nesting import gathered, nest, unnest
from shopwright.operators.ordered import ordered
from shopwright.schemas import CELLS, PAGE_VIEW, TRANSACTIONS
from shopwright.shared import new_folder
from shopwright.sources.entities import read_cells, read_entity, register_views


def rows(df):
    return [tuple(r) for r in df.collect()]


def ts(text):
    return dt.datetime.fromisoformat(text)


# --- sales -------------------------------------------------------------------


@pytest.fixture(scope="module")
def transactions(spark):
    def item(product, quantity, price):
        return (product, quantity, price, round(quantity * price, 2))

    def txn(tid, user, when, items, total):
        return (tid, None, user, ts(when), items, total, None, total, "paypal", "completed")

    return spark.createDataFrame(
        [
            txn("t1", "u1", "2025-03-01T23:59:59.999999", [item("p1", 2, 5.0), item("p2", 1, 7.5)], 17.5),
            txn("t2", "u1", "2025-03-02T00:00:00", [item("p1", 1, 5.0)], 4.5),
            txn("t3", "ghost", "2025-03-02T12:00:00", [], 3.0),
            txn("t4", "u3", "2025-03-02T12:00:00", None, 2.0),
            txn("t5", "u3", "2025-03-02T12:00:00", [item("unknown", 1, 9.0)], 9.0),
        ],
        TRANSACTIONS,
    )


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame(
        [("p1", "c1", True, 3), ("p2", "c2", True, 0), ("p3", "c2", False, 5)],
        "product_id string, category_id string, is_active boolean, current_stock bigint",
    )


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame(
        [("u1", ("A", "NY", "US")), ("u2", ("B", "CA", "US")), ("u3", ("C", None, "US"))],
        "user_id string, geo_data struct<city:string,state:string,country:string>",
    )


def test_explode_drops_empty_and_null_items(transactions):
    items = sales.explode_items(transactions)
    assert [(r.transaction_id, r.product_id) for r in items.collect()] == [
        ("t1", "p1"), ("t1", "p2"), ("t2", "p1"), ("t5", "unknown"),
    ]
    assert items.filter("transaction_id = 't1'").first().order_subtotal == 17.5


def test_top_products_ties_go_to_the_smaller_id(spark):
    items = spark.createDataFrame(
        [("b", 1, 5.0), ("a", 2, 5.0), ("c", 1, 9.0)], "product_id string, quantity long, subtotal double"
    )
    assert rows(sales.top_products(items, 2)) == [("c", 9.0, 1), ("a", 5.0, 2)]


def test_category_revenue_by_item_and_by_order_total(transactions, products):
    items = sales.explode_items(transactions)
    assert rows(sales.revenue_by_category(items, products)) == [("c1", 15.0), ("c2", 7.5)]
    assert rows(sales.revenue_by_category_order_total(items, products)) == [("c1", 22.0), ("c2", 17.5)]


def test_lookup_keeps_unmatched_items_and_matches_nulls(spark, products):
    items = spark.createDataFrame([(1, "p1"), (2, "zzz"), (3, None)], "n int, product_id string")
    goods = products.select("product_id", "category_id").union(
        spark.createDataFrame([(None, "c9"), ("p1", "c8")], "product_id string, category_id string")
    )
    found = sales.lookup_products(items, goods, ["category_id"])
    got = {r.n: [p.category_id for p in r.product_info] for r in found.collect()}
    assert got == {1: ["c1", "c8"], 2: [], 3: ["c9"]}
    many = goods.select("product_id", "category_id").union(
        spark.range(1500).select(F.lit("zzz"), F.col("id").cast("string"))
    )
    found = {r.n: len(r.product_info) for r in sales.lookup_products(items, many, ["category_id"]).collect()}
    assert found == {1: 2, 2: 1500, 3: 1}


def test_state_revenue(users, transactions):
    assert rows(sales.revenue_by_state(users, transactions)) == [("NY", 22.0), (None, 11.0)]
    register_views(v_users=users, v_transactions=transactions)
    by_sql = users.sparkSession.sql(
        "SELECT geo_data.state, count(*) AS orders FROM v_users JOIN v_transactions USING (user_id) "
        "GROUP BY ALL ORDER BY ALL"
    )
    assert rows(by_sql) == [(None, 2), ("NY", 2)]


def test_days_split_at_midnight(transactions):
    assert rows(sales.daily_sales(transactions)) == [
        (ts("2025-03-01"), 17.5), (ts("2025-03-02"), 18.5),
    ]


def test_order_totals_round_half_up(spark):
    items = spark.createDataFrame([("o", 0.05), ("o", 0.05)], "order_id string, subtotal double")
    got = rows(sales.order_totals(items, ["order_id"], F.lit(0.05)))
    assert got == [("o", Decimal("0.10"), Decimal("0.01"), Decimal("0.09"))]


def test_defaults(transactions):
    filled = sales.fill_defaults(transactions, {"discount": 0.0, "session_id": "none"})
    assert set(rows(filled.select("discount", "session_id"))) == {(0.0, "none")}


# --- catalogue and stock -------------------------------------------------------


def test_catalog(spark):
    cats = spark.createDataFrame(
        [
            ("cat_001", "One", [("sub_001_00", "a", 0.1), ("sub_001_01", "b", 0.2)]),
            ("cat_002", "Two", [("sub_002_00", "c", 0.1)]),
        ],
        "category_id string, name string, "
        "subcategories array<struct<subcategory_id:string,name:string,profit_margin:double>>",
    )
    goods = spark.createDataFrame(
        [("p1", "cat_001"), ("p2", "cat_002"), ("p3", "cat_009")], "product_id string, category_id string"
    )
    got = {r.product_id: tuple(r.category) for r in catalog.product_catalog(goods, cats).collect()}
    assert got == {
        "p1": ("cat_001", "One", "sub_001_01", "b"),
        "p2": ("cat_002", "Two", None, None),
        "p3": ("cat_009", None, None, None),
    }


def test_purchasable(products):
    assert rows(catalog.purchasable_products(products).select("product_id")) == [("p1",)]


def test_price_history(spark):
    day1, day2 = ts("2025-01-01"), ts("2025-01-02")
    goods = spark.createDataFrame(
        [("p", [(9.0, day2), (5.0, day1), (7.0, day2)]), ("none", [])],
        "product_id string, price_history array<struct<price:double,date:timestamp>>",
    )
    got = {r.product_id: r for r in catalog.sort_price_history(goods).collect()}
    assert [h.price for h in got["p"].price_history] == [5.0, 7.0, 9.0]
    assert (got["p"].base_price, got["p"].current_price, got["p"].creation_date) == (5.0, 9.0, day1)
    assert got["none"].current_price is None
    many = goods.filter("product_id = 'p'").select(
        "product_id",
        F.transform(
            F.sequence(F.lit(0), F.lit(1499)),
            lambda i: F.struct((i % 7).cast("double").alias("price"), F.timestamp_seconds(i * 60).alias("date")),
        ).alias("price_history"),
    )
    by_price = nest(unnest(many, "price_history"), ["product_id"], ["price"], ["price", "date"], "price_history", part_rows=100)
    for listed in (many, by_price):
        whole = catalog.sort_price_history(listed, part_rows=100)
        assert sorted(r.part for r in whole.collect()) == list(range(15))
        facts = whole.select("base_price", "current_price", "creation_date").distinct().collect()
        assert [(r.base_price, r.current_price) for r in facts] == [(0.0, float(1499 % 7))]
        (one,) = gathered(whole, ["product_id"], "price_history").collect()
        assert [h.price for h in one.price_history] == [float(i % 7) for i in range(1500)]
    changes = unnest(goods, "price_history")
    timeline = catalog.price_timeline(changes).orderBy("seq")
    assert [(r.seq, r.price) for r in timeline.collect()] == [(1, 5.0), (2, 7.0), (3, 9.0)]
    assert rows(catalog.price_summary(changes)) == [("p", day1, 5.0, 9.0, 3)]


def test_stock_skips_what_it_cannot_cover(spark):
    goods = spark.createDataFrame([("p", 5), ("idle", 4)], "product_id string, current_stock long")
    demands = spark.createDataFrame(
        [(1, "p", 3), (2, "p", 4), (3, "p", 2), (4, "p", 1), (5, "ghost", 1), (6, "p", 0), (7, "p", -2), (8, "p", None)],
        "turn_no int, product_id string, quantity long",
    )
    left = inventory.stock_depletion(goods, demands, ["turn_no"])
    assert sorted(rows(left)) == [("idle", 4, 4, 0, 0), ("p", 5, 0, 3, 4)]
    assert rows(inventory.remaining_stock(left, "remaining_stock")) == [(4,)]
    filled = inventory.filled_demands(goods, demands, ["turn_no"])
    assert sorted(rows(filled)) == [(1, "p", 3), (3, "p", 2), (6, "p", 0)]


@pytest.mark.parametrize("cut", [False, True])
def test_stock_matches_one_by_one_service(spark, cut):
    import random

    rng = random.Random(11)
    goods = [(p, rng.randint(0, 60)) for p in range(6)]
    asks = [(i, rng.choice([0, 0, 0, 1, 2, 3, 4, 5, 9]), rng.randint(-1, 25)) for i in range(700)]
    left, want = dict(goods), []
    for i, p, q in asks:
        if p in left and 0 <= q <= left[p]:
            left[p] -= q
            want.append((i, p, q))
    products = spark.createDataFrame(goods, "product_id int, current_stock long")
    demands = spark.createDataFrame(asks, "no int, product_id int, quantity long").repartition(4)
    heavy = F.lit(True) if cut else None
    got = inventory.stock_depletion(products, demands, ["no"], heavy=heavy)
    assert {r.product_id: r.remaining_stock for r in got.collect()} == left
    assert sorted(rows(inventory.filled_demands(products, demands, ["no"], heavy=heavy))) == want


# --- sessions ------------------------------------------------------------------


@pytest.fixture(scope="module")
def documents(spark):
    def view(second, page, product=None):
        return (ts(f"2025-03-01T10:00:{second:02d}"), page, product, None, 5)

    def doc(sid, user, start, views, cart, viewed, duration=100):
        place, device = ("X", "NY", "US", "1.2.3.4"), ("mobile", "iOS", "Safari")
        return (
            sid, user, ts(start), ts(start), duration, place, device, viewed, views, cart, None, "direct",
        )

    from shopwright.schemas import SESSIONS

    return spark.createDataFrame(
        [
            doc("s1", "u1", "2025-03-01T10:00:00",
                [view(0, "home"), view(5, "product_detail", "p1"), view(9, "checkout")],
                {"p1": (2, 5.0)}, ["p1"]),
            doc("s2", "u1", "2025-03-01T10:00:00", [view(0, "search")], {"p2": (0, 7.5)}, []),
            doc("s3", "u2", "2025-03-05T10:00:00.250000", [view(0, "home"), view(1, "home")], {}, []),
            doc("s4", "u2", "2025-03-06T10:00:00", [view(0, "checkout")], {}, []),
        ],
        SESSIONS,
    )


def test_conversion_uses_the_unfiltered_cart(documents):
    status = S.classify_conversion(documents)
    assert {r.session_id: r.conversion_status for r in status.collect()} == {
        "s1": "converted", "s2": "abandoned", "s3": "browsed", "s4": "browsed",
    }
    stored = S.drop_empty_cart_lines(documents).filter("session_id = 's2'").first()
    assert stored.cart_contents == {}
    assert sorted(rows(S.conversion_funnel(status))) == [
        ("abandoned", 1), ("browsed", 2), ("converted", 1),
    ]


def test_sessions_in_parts_count_once(documents):
    """Pages and cart in different parts, and more page views than a part holds."""
    home = F.array_repeat(F.struct(F.lit("home").alias("page_type")), 1000)
    till = F.array(F.struct(F.lit("checkout").alias("page_type")))
    cart = F.create_map(F.lit("p1"), F.struct(F.lit(1).alias("quantity")))
    ids = documents.select("session_id").filter("session_id in ('s1', 's2')")
    first = ids.select("session_id", F.lit(0).alias("part"), home.alias("page_views"), cart.alias("cart_contents"))
    later = first.filter("session_id = 's1'").select("session_id", F.lit(1).alias("part"), till.alias("page_views"), F.map_filter("cart_contents", lambda k, v: F.lit(False)).alias("cart_contents"))
    status = S.classify_conversion(first.unionByName(later))
    assert sorted((r.session_id, r.part, r.conversion_status) for r in status.collect()) == [
        ("s1", 0, "converted"), ("s1", 1, "converted"), ("s2", 0, "abandoned"),
    ]
    assert sorted(rows(S.conversion_funnel(status))) == [("abandoned", 1), ("converted", 1)]


def test_events_without_user_or_time(spark):
    events = spark.createDataFrame(
        [(1, "u", ts("2025-03-01")), (2, None, ts("2025-03-01")), (3, "u", None)], "event_id int, user_id string, ts timestamp"
    )
    assert sorted(r.event_id for r in S.unassigned_events(events).collect()) == [2, 3]


def test_sessions_after_a_time_need_no_earlier_events(spark):
    import random

    rng = random.Random(4)
    start = ts("2025-03-01")
    seen = [(rng.randrange(9), start + dt.timedelta(seconds=rng.randrange(10 * 86400))) for _ in range(400)]
    events = spark.createDataFrame(seen, "user_id int, ts timestamp")
    for after in ("2025-03-02", "2025-03-05 12:00:00"):
        spans = [S.sessions_from_events(e) for e in (events, S.events_for_sessions_after(events, after))]
        found = [S.sessions_in_range(s, after, "2025-03-09").select("user_id", "start_time", "end_time") for s in spans]
        assert sorted(rows(found[0])) == sorted(rows(found[1])) != []


def test_cart_fold_keeps_the_first_price(spark):
    adds = spark.createDataFrame(
        [("s", "p1", 2, 6.0, 2), ("s", "p1", 1, 5.0, 1), ("s", "p2", 0, 1.0, 3), ("t", "p2", 0, 1.0, 1)],
        "session_id string, product_id string, quantity long, price double, at int",
    )
    entries = S.cart_entries(adds, ["session_id"], ["at"])
    assert sorted(rows(entries)) == [("s", "p1", 3, 5.0), ("s", "p2", 0, 1.0), ("t", "p2", 0, 1.0)]
    stored = {r.session_id: r.cart_contents for r in S.cart_contents(entries, ["session_id"]).collect()}
    assert {k: {p: tuple(v) for p, v in c.items()} for k, c in stored.items()} == {
        "s": {"p1": (3, 5.0)}, "t": {},
    }


def test_transitions_skip_one_page_sessions(documents):
    views = S.explode_page_views(documents)
    got = S.page_transitions(views, ["session_id"], ["timestamp", "pv"])
    assert sorted(rows(got)) == [
        ("home", "home", 1, 0.5), ("home", "product_detail", 1, 0.5), ("product_detail", "checkout", 1, 1.0),
    ]


def test_durations_end_with_the_session(spark):
    views = spark.createDataFrame(
        [("s", ts("2025-03-01T10:00:00"), ts("2025-03-01T10:00:30")),
         ("s", ts("2025-03-01T10:00:10.900000"), ts("2025-03-01T10:00:30"))],
        "session_id string, timestamp timestamp, session_end timestamp",
    )
    got = S.view_durations(views, ["session_id"], ["timestamp"], "session_end")
    assert sorted(r.view_duration for r in got.collect()) == [10, 19]


def test_session_breaks_exactly_beyond_the_gap(spark):
    start = ts("2025-03-01T00:00:00")
    steps = [0, 6 * 3600, 12 * 3600, 18 * 3600 + 1, 100 * 3600]
    events = spark.createDataFrame(
        [(i, "u", start + dt.timedelta(seconds=s)) for i, s in enumerate(steps)] + [(9, None, start)],
        "event_id int, user_id string, ts timestamp",
    )
    per_session = S.sessions_from_events(events, {"views": ("sum", F.lit(1))}).orderBy("session_no")
    assert [(r.session_no, r.views, r.duration_seconds) for r in per_session.collect()] == [
        (1, 3, 43200), (2, 1, 0), (3, 1, 0),
    ]
    want = [(0, 1), (1, 1), (2, 1), (3, 2), (4, 3)]
    for heavy in (None, F.lit(True)):
        got = S.assign_sessions(events, "event_id", heavy=heavy)
        assert sorted((r.event_id, r.session_no) for r in got.collect()) == want


def test_sessions_before_1970(spark):
    start = dt.datetime(1970, 1, 1) - dt.timedelta(hours=5)
    events = spark.createDataFrame(
        [(0, "u", start), (1, "u", start + dt.timedelta(hours=10))], "event_id int, user_id string, ts timestamp"
    )
    assert S.sessions_from_events(events).count() == 2


@pytest.fixture(scope="module")
def bounds(spark):
    return spark.createDataFrame(
        [(s, "u1", ts(w), 60) for s, w in [
            ("at start", "2025-03-01T00:00:00"), ("after start", "2025-03-01T00:00:01"),
            ("at end", "2025-03-31T00:00:00"), ("after end", "2025-03-31T00:00:01")]],
        "session_id string, user_id string, start_time timestamp, duration_seconds long",
    )


def test_range_excludes_start_and_includes_end(bounds):
    got = S.user_sessions(bounds, "u1", "2025-03-01", "2025-03-31")
    assert [r.session_id for r in got.collect()] == ["at end", "after start"]


def test_key_range_equals_time_range(bounds):
    keyed = bounds.select(
        row_key("user_id", "start_time").alias("row_key"), F.lit("f").alias("family"),
        F.lit("q").alias("qualifier"), F.col("session_id").alias("value"), F.lit(0).alias("version"), F.lit("").alias("put"),
    )
    got = cells.rows_of_user(keyed, "u1", "2025-03-01", "2025-03-31").orderBy("row_key")
    assert [r.value for r in got.collect()] == ["at end", "after start"]
    keys = [r.row_key for r in got.collect()]
    assert [r.value for r in cells.rows_between(keyed, keys[0], keys[1]).collect()] == ["at end"]


# --- customers -------------------------------------------------------------------


def test_summary_and_segments(users, transactions):
    summed = customers.user_summary(users, transactions)
    assert {r.user_id: tuple(r.summary) for r in summed.collect()} == {
        "u1": (2, 11.0), "u2": (0, 0.0), "u3": (2, 5.5),
    }
    assert rows(customers.purchase_segments(summed)) == [(0, 1), (2, 2)]


def test_engagement_counts_bad_durations_as_zero(spark, users):
    when = ts("2025-03-02")
    found = spark.createDataFrame(
        [("u1", when, "120"), ("u1", when, "abc"), ("u1", when, None), ("u3", ts("2025-04-02"), "5")],
        "user_id string, start_time timestamp, duration string",
    )
    got = customers.engagement(users, found, "2025-03-01", "2025-03-31", "duration")
    assert sorted(rows(got)) == [("u1", 3, 120), ("u2", 0, 0), ("u3", 0, 0)]


def test_clv_edges_give_zero(spark):
    day = ts("2025-01-01")
    people = spark.createDataFrame(
        [("bought nothing", day), ("no sessions", day), ("new", ts("2025-03-01")), ("undated", None), ("ok", day)],
        "user_id string, registration_date timestamp",
    )
    spent = spark.createDataFrame(
        [(u, 100.0, 2) for u in ("no sessions", "new", "undated", "ok")],
        "user_id string, total_spend double, purchase_count long",
    )
    active = spark.createDataFrame(
        [(u, 6, 7200) for u in ("bought nothing", "new", "undated", "ok")],
        "user_id string, session_count long, total_duration long",
    )
    got = customers.customer_lifetime_value(people, spent, active, "2025-03-02")
    value = {r.user_id: r.clv for r in got.collect()}
    months = 60 / 30.0
    assert value["ok"] == 50.0 * 6 * (6 / months / 10.0 + 2.0)
    assert value["bought nothing"] == value["no sessions"] == value["undated"] == 0.0
    zero = customers.customer_lifetime_value(people, spent, active, "2025-03-01")
    assert {r.user_id: r.clv for r in zero.collect()}["new"] == 0.0
    assert got.first().user_id == "new"


# Published sample of ranked customers.
SAMPLE = """
user_000731,2993.85,1,107,177317,1.5778353763375E7
user_000406,3099.92,1,94,190278,1.5401549530399999E7
user_000901,2525.31,1,108,196111,1.4857232082299998E7
user_000068,2497.27,1,105,176439,1.2851294794624997E7
user_000711,2193.48,1,102,206190,1.2814419833999999E7
user_000537,3138.51,1,85,171102,1.2679292703250002E7
user_000538,2782.14,1,94,173345,1.2592607077833332E7
user_000371,4144.6,2,111,195923,1.2518679681083335E7
user_000180,2188.59,1,104,187468,1.1852839270133335E7
user_000882,4143.75,1,75,134946,1.164963515625E7
"""


def test_clv_hours_only_gives_the_sample(spark):
    sample = [line.split(",") for line in SAMPLE.split()]
    people = spark.createDataFrame([(r[0], None) for r in sample], "user_id string, registration_date timestamp")
    spent = spark.createDataFrame(
        [(r[0], float(r[1]), int(r[2])) for r in sample], "user_id string, total_spend double, purchase_count long"
    )
    active = spark.createDataFrame(
        [(r[0], int(r[3]), int(r[4])) for r in sample], "user_id string, session_count long, total_duration long"
    )
    got = customers.customer_lifetime_value(people, spent, active, "2025-05-01", "hours_only").collect()
    assert [r.user_id for r in got] == [r[0] for r in sample]
    for row, want in zip(got, sample):
        assert row.clv == pytest.approx(float(want[5]), rel=1e-12)
    with pytest.raises(ValueError):
        customers.customer_lifetime_value(people, spent, active, "2025-05-01", "other")


def test_merge_updates_only_what_exists(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)], "id int, name string, x double")
    fresh = spark.createDataFrame([(2, 9.0), (3, None), (4, 8.0)], "id int, x double")
    got = customers.merge_update(target, fresh, "id", ["x"])
    assert sorted(rows(got)) == [(1, "a", 1.0), (2, "b", 9.0), (3, "c", None)]


# --- cells -----------------------------------------------------------------------


def test_session_cells(documents):
    got = cells.session_cells(S.classify_conversion(documents.filter("session_id = 's1'")), F.lit(0))
    table = {(r.family, r.qualifier): r.value for r in got.collect()}
    assert len(table) == 8 + 3 * 5
    assert table["session_data", "start_time"] == "2025-03-01T10:00:00"
    assert table["session_data", "duration"] == "100"
    assert json.loads(table["session_data", "geo_data"])["ip_address"] == "1.2.3.4"
    assert json.loads(table["session_data", "viewed_products"]) == ["p1"]
    assert table["page_views", "pv_1_product_id"] == "p1"
    assert table["page_views", "pv_0_product_id"] == ""
    key = 999_999_999_999 - int(ts("2025-03-01T10:00:00").replace(tzinfo=dt.timezone.utc).timestamp())
    assert {r.row_key for r in got.collect()} == {f"u1:{key}"}


def test_viewed_products_are_one_list_for_any_number(spark, documents):
    views = spark.range(4000).select(F.lit("s1").alias("session_id"), (F.col("id") % 2000).alias("product_id"))
    (seen,) = S.viewed_products(views, ["session_id"]).collect()
    assert seen.viewed_products == list(range(2000))
    entries = views.distinct().withColumns({"quantity": F.lit(1), "price": F.lit(2.0)})
    (cart,) = S.cart_contents(entries, ["session_id"]).collect()
    assert len(cart.cart_contents) == 2000
    many = documents.filter("session_id = 's1'").withColumn(
        "viewed_products", F.transform(F.sequence(F.lit(1), F.lit(2000)), lambda i: i.cast("string"))
    )
    got = cells.session_cells(S.classify_conversion(many), F.lit(0)).filter("qualifier like 'viewed%'").collect()
    assert [(r.qualifier, len(json.loads(r.value))) for r in got] == [("viewed_products", 2000)]


def test_key_collision_merges_cell_by_cell(documents):
    both = S.classify_conversion(documents.filter("user_id = 'u1'"))
    older_first = F.when(F.col("session_id") == "s1", 1).otherwise(2)
    # In one write, the put that starts later wins, then the greater id: s1 and s2 start in one second.
    for version, winner in ((older_first, "s2"), (3 - older_first, "s1"), (F.lit(0), "s2")):
        written = cells.session_cells(both, version)
        table = {r.qualifier: r.value for r in cells.latest_cells(written).collect()}
        mine = {r.qualifier: r.value for r in written.filter(F.col("put").endswith(winner)).collect()}
        assert table["session_id"] == winner
        assert {q: table[q] for q in mine} == mine
        assert table["pv_2_page_type"] == "checkout"
        (row,) = cells.wide_rows(written).collect()
        assert row.cells["session_data:session_id"] == winner and len(row.cells) == len(table)


def test_three_versions_stay(spark):
    history = spark.createDataFrame([("r", "f", "q", str(v), v, "") for v in range(1, 5)], CELLS)
    kept = cells.retain_versions(history)
    assert sorted(r.version for r in kept.collect()) == [2, 3, 4]
    assert rows(cells.latest_cells(history)) == [("r", "f", "q", "4", 4, "")]
    assert rows(cells.rows_between(history, "r", "s")) == [("r", "f", "q", "4", 4, "")]
    # The later of two puts counts, not the greater text.
    puts = spark.createDataFrame([("r", "f", "q", "60", 0, "b"), ("r", "f", "q", "500", 0, "a")], CELLS)
    assert [r.value for r in cells.latest_cells(puts).collect()] == ["60"]


def test_metric_cells(spark):
    daily = spark.createDataFrame([(ts("2025-03-01"), 12345678.5)], "day timestamp, total_revenue double")
    got = cells.metric_cells(daily, "day", "total_revenue", "revenue", "total", F.lit(7))
    assert rows(got) == [("2025-03-01 00:00:00", "revenue", "total", "12345678.5", 7, "")]
    values = [0.123456, 0.00049, float("nan"), float("inf"), -1e-9, 15.0, 1e20, None, 0.0]
    many = spark.createDataFrame(list(enumerate(values)), "k int, v double")
    text = [r.value for r in cells.metric_cells(many, "k", "v", "f", "q", F.lit(0)).orderBy(F.col("row_key").cast("int")).collect()]
    assert text == ["0.123456", "0.00049", "NaN", "Infinity", "-0.000000001", "15.0", "1.0E20", None, "0.0"]


def test_money_is_exact_or_an_error(spark):
    def total(*values):
        return spark.createDataFrame([(v,) for v in values], "x double").agg(F.sum(money("x")).alias("s")).first().s

    assert total(0.004, 0.004) == Decimal("0.008")
    assert total(*[0.1] * 10) == Decimal("1.0")
    assert total(1e20, 0.01, None) == Decimal("100000000000000000000.01")
    for wrong in (float("nan"), float("inf"), 1e30):
        with pytest.raises(Exception):
            total(1.0, wrong)


def test_later_category_documents_do_not_multiply_products(spark):
    kind = "category_id string, name string, subcategories array<struct<subcategory_id:string,name:string>>"
    cats = spark.createDataFrame([("cat_001", "A", []), ("cat_001", "B", []), ("cat_001", "B", [])], kind)
    goods = spark.createDataFrame([("p1", "cat_001")], "product_id string, category_id string")
    assert [r.category.name for r in catalog.product_catalog(goods, cats).collect()] == ["B"]


# --- sources and sinks -------------------------------------------------------------


def test_read_json_arrays_and_folders(spark, tmp_path):
    record = {
        "user_id": "user_000001",
        "geo_data": {"city": "X", "state": "NY", "country": "US"},
        "registration_date": "2025-01-02T03:04:05.000006",
        "last_active": "2025-01-02T03:04:05",
    }
    (tmp_path / "users.json").write_text(json.dumps([record, record]))
    (tmp_path / "notes.txt").write_text("not data")
    for path in (tmp_path / "users.json", tmp_path):
        people = read_entity(spark, "users", str(path))
        assert people.count() == 2
        first = people.first()
        assert first.geo_data.state == "NY"
        assert first.registration_date == ts("2025-01-02T03:04:05.000006")
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_entity(spark, "users", str(tmp_path / "missing.json"))


def test_cart_map_is_read_as_a_map(spark, tmp_path):
    one = {"session_id": "s", "user_id": "u", "cart_contents": {"prod_00001": {"quantity": 2, "price": 5.5}}}
    (tmp_path / "sessions_0.json").write_text(json.dumps([one]))
    got = read_entity(spark, "sessions", str(tmp_path)).first()
    assert tuple(got.cart_contents["prod_00001"]) == (2, 5.5)


def test_json_files_hold_a_limited_number_of_records(spark, tmp_path):
    sinks.export(spark.range(0, 25, 1, 1), str(tmp_path / "out"), "json", max_records=10)
    files = list((tmp_path / "out").glob("*.json"))
    assert sorted(len(f.read_text().splitlines()) for f in files) == [5, 10, 10]


def test_single_csv_with_header(spark, tmp_path):
    sinks.export(spark.range(0, 100, 1, 4), str(tmp_path / "out"), "csv", single_file=True)
    (file,) = (tmp_path / "out").glob("*.csv")
    assert file.read_text().splitlines()[:2] == ["id", "0"]
    with pytest.raises(ValueError):
        sinks.export(spark.range(1), str(tmp_path / "x"), "avro")


def test_tables(spark):
    path = new_folder(spark, "table")
    name = "ensured_" + path.rsplit("-", 1)[-1]
    sinks.ensure_table(spark, name, CELLS, path)
    row = spark.createDataFrame([("r", "f", "q", "v", 1, "")], CELLS)
    sinks.append(row, path)
    sinks.ensure_table(spark, name, CELLS, path)
    spark.catalog.refreshTable(name)
    assert rows(spark.table(name)) == [("r", "f", "q", "v", 1, "")]
    sinks.append(row, path)
    assert read_cells(spark, path).count() == 2


def test_cell_table_round_trip(spark, documents):
    path = new_folder(spark, "cells")
    written = cells.session_cells(S.classify_conversion(documents), F.lit(0))
    sinks.write_cells(written, path)
    assert sorted(rows(read_cells(spark, path))) == sorted(rows(written))


# --- ordering and nesting -------------------------------------------------------------


@pytest.mark.parametrize("cut", [False, True])
def test_ordered_matches_plain_python(spark, cut):
    import random

    rng = random.Random(5)
    data = [
        (rng.choice(["a", "a", "a", "b", None]), rng.choice([None, *range(40)]), i, rng.choice([None, 1, 2, 5]))
        for i in range(600)
    ]
    df = spark.createDataFrame(data, "k string, o int, id int, v int").repartition(5)
    got = ordered(
        df, ["k"], ["o", "id"], position="n", lags={"was": "v"}, leads={"next": "v"},
        running={"total": "v"}, heavy=F.lit(True) if cut else None,
    )
    want = []
    for key in {r[0] for r in data}:
        group = sorted((r for r in data if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        total = None
        for i, r in enumerate(group):
            total = total if r[3] is None else (total or 0) + r[3]
            was = group[i - 1][3] if i else None
            following = group[i + 1][3] if i + 1 < len(group) else None
            want.append((*r, i + 1, was, following, total))
    columns = ["k", "o", "id", "v", "n", "was", "next", "total"]
    key = lambda r: r[2]
    assert sorted(rows(got.select(columns)), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("cut", [False, True])
def test_copies_are_spread_and_kept(spark, cut):
    df = spark.createDataFrame([("k", 1)] * 900 + [("j", 2)], "k string, v int").repartition(4)
    nested = nest(df, ["k"], ["v"], ["v"], "vs", part_rows=100, heavy=F.lit(True) if cut else None)
    sizes = sorted((r.k, r.part, len(r.vs)) for r in nested.collect())
    assert sizes == [("j", 0, 1)] + [("k", p, 100) for p in range(9)]
    assert unnest(nested, "vs", index="i", part_rows=100).filter("k = 'k'").select("i").distinct().count() == 900


# --- scalars ---------------------------------------------------------------------------


def test_scalars(spark):
    df = spark.createDataFrame(
        [(ts("2025-03-01T10:00:00"), ts("2025-03-01T10:00:00.5"), "cat_012", 7, 1234567, "big red box", {"a": 1})],
        "whole timestamp, half timestamp, cat string, small int, big int, name string, m map<string,int>",
    )
    got = df.select(
        iso_text("whole"), iso_text("half"), iso_text(add_seconds("whole", F.lit(61))),
        subcategory_id("cat", 1), padded_id("user_", 6, "small"), padded_id("user_", 6, "big"),
        title_case("name"), map_value("m", "a", 0), map_value("m", "b", 0),
        row_key(F.lit("u"), "half"),
    ).first()
    assert tuple(got) == (
        "2025-03-01T10:00:00", "2025-03-01T10:00:00.500000", "2025-03-01T10:01:01",
        "sub_012_01", "user_000007", "user_1234567", "Big Red Box", 1, 0, "u:998259176798",  # 999999999999 - 1740823200.5
    )


def test_page_view_schema_has_nullable_ids():
    assert PAGE_VIEW["product_id"].nullable and PAGE_VIEW["category_id"].nullable


def test_empty_inputs_stay_empty(spark):
    none = spark.createDataFrame([], "k string, v int")
    assert ordered(none, ["k"], ["v"], position="n").count() == 0
    assert ordered(none, ["k"], ["v"], position="n", lags={"p": "v"}, heavy=F.lit(True)).count() == 0
    assert nest(none, ["k"], ["v"], ["v"], "vs").count() == 0
