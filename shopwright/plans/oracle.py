"""The same queries in ANSI SQL over the star-schema tables, for checking results."""

from __future__ import annotations

ITEMS = """items AS (
  SELECT l_orderkey AS transaction_id, l_linenumber AS line, l_partkey AS product_id,
         CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice AS subtotal,
         CAST(l_extendedprice AS DECIMAL(28,6)) AS amount, l_discount, l_shipdate AS ship_date
  FROM lineitem)"""

EVENTS = """ev AS (
  SELECT event_id, ts, user_id, event_type AS page_type, epoch_us(ts) AS us, value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id
  FROM events)"""

VIEWS = EVENTS + """,
marked AS (
  SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= 21600000000
                 THEN 0 ELSE 1 END AS is_new FROM ev),
views AS (
  SELECT *, CAST(sum(is_new) OVER (PARTITION BY user_id ORDER BY ts, event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_no FROM marked)"""

SESSIONS = VIEWS + """,
sess AS (
  SELECT user_id, session_no, printf('sess_%06d_%d', user_id, session_no) AS session_id,
         min(ts) AS start_time, max(ts) AS end_time, (max(us) - min(us)) // 1000000 AS duration_seconds,
         count(*) AS views,
         CASE WHEN max(CASE WHEN page_type = 'purchase' THEN 1 ELSE 0 END) = 1 THEN 'converted'
              WHEN max(CASE WHEN page_type = 'click' THEN 1 ELSE 0 END) = 1 THEN 'abandoned'
              ELSE 'browsed' END AS conversion_status
  FROM views GROUP BY user_id, session_no)"""


VIEWED = """viewed AS (
  SELECT user_id, session_no, CAST(count(*) AS INTEGER) AS products,
         string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY product_id) AS ids
  FROM (SELECT DISTINCT user_id, session_no, product_id FROM views WHERE product_id IS NOT NULL) GROUP BY 1, 2)"""


def _key(user: str, ts: str) -> str:
    return f"printf('user_%06d:%d', {user}, (999999999999000000 - epoch_us({ts})) // 1000000)"


def _put(ts: str, label: str) -> str:
    return f"lpad(CAST(epoch_us({ts}) + 4611686018427387904 AS VARCHAR), 19, '0') || ':' || {label}"


def _iso(ts: str) -> str:
    return (
        f"CASE WHEN epoch_us({ts}) % 1000000 = 0 THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S') "
        f"ELSE strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f') END"
    )


ENGAGED = """engaged AS (
  SELECT c.c_custkey AS user_id, coalesce(e.n, 0) AS session_count,
         CAST(coalesce(e.d, 0) AS BIGINT) AS total_duration
  FROM customer c LEFT JOIN (
    SELECT user_id, count(*) AS n, sum(duration_seconds) AS d FROM sess
    WHERE start_time > TIMESTAMP '2024-01-05' AND start_time <= TIMESTAMP '2024-01-25'
    GROUP BY user_id) e ON e.user_id = c.c_custkey)"""

PURCHASES = """purchases AS (
  SELECT o_custkey AS user_id, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_spend,
         count(*) AS purchase_count, min(o_orderdate) AS registered
  FROM orders GROUP BY o_custkey)"""

SUMMARY = """summaries AS (
  SELECT c_custkey AS user_id, coalesce(purchase_count, 0) AS total_purchases,
         coalesce(total_spend / purchase_count, 0.0::DOUBLE) AS avg_spend
  FROM customer LEFT JOIN purchases ON user_id = c_custkey)"""


def _clv(mode: str, tail: str = "") -> str:
    hours = "total_duration / 3600.0::DOUBLE"
    monthly = "session_count / nullif(tenure_days / 30.0::DOUBLE, 0) / 10.0::DOUBLE"
    score = f"{monthly} + {hours}" if mode == "current" else hours
    return f"""WITH {SESSIONS}, {ENGAGED}, {PURCHASES},
base AS (
  SELECT g.user_id, coalesce(p.total_spend, 0.0::DOUBLE) AS total_spend,
         coalesce(p.purchase_count, 0) AS purchase_count, g.session_count, g.total_duration,
         CAST(date_diff('day', CAST(p.registered AS DATE), DATE '2024-02-01') AS INTEGER) AS tenure_days
  FROM engaged g LEFT JOIN purchases p ON p.user_id = g.user_id),
scored AS (SELECT *, {score} AS engagement_score FROM base)
SELECT *, coalesce(CASE WHEN purchase_count > 0 THEN total_spend / purchase_count ELSE 0.0::DOUBLE END
                   * session_count * engagement_score, 0.0::DOUBLE) AS clv
FROM scored {tail}"""


TOP_PRODUCTS = f"""WITH {ITEMS}
SELECT product_id, CAST(sum(amount) AS DOUBLE) AS total_revenue, CAST(sum(quantity) AS BIGINT) AS total_quantity
FROM items GROUP BY product_id ORDER BY sum(amount) DESC, product_id LIMIT 10"""

BY_CATEGORY = f"""WITH {ITEMS}
SELECT p_brand AS category_id, CAST(sum(amount) AS DOUBLE) AS total_revenue
FROM items JOIN part ON p_partkey = product_id GROUP BY p_brand"""

BY_CATEGORY_ORDER_TOTAL = """
SELECT p_brand AS category_id, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey GROUP BY p_brand"""

DAILY = """
SELECT date_trunc('day', o_orderdate) AS day, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
FROM orders GROUP BY 1"""

FUNNEL = f"""WITH {SESSIONS} SELECT conversion_status, count(*) AS count FROM sess GROUP BY 1"""

SEGMENTS = f"""WITH {PURCHASES}, {SUMMARY}
SELECT total_purchases AS purchase_count, count(*) AS user_count FROM summaries GROUP BY 1"""

BY_STATE = """
SELECT n_name AS state, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN orders ON o_custkey = c_custkey
GROUP BY n_name ORDER BY sum(CAST(o_totalprice AS DECIMAL(18,2))) DESC, n_name"""

ORDERS = """
SELECT o_orderkey AS transaction_id, o_custkey AS user_id, o_orderdate AS "timestamp",
       o_totalprice AS total, o_orderstatus AS status FROM orders"""

USER_RANGES = """ranges AS (
  SELECT DISTINCT * FROM (
    SELECT c_custkey AS user_id, TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 15 AS INTEGER)) AS "start",
           TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 15 + 1 + c_custkey % 20 AS INTEGER)) + to_hours(c_custkey % 24) AS "end"
    FROM customer
    UNION ALL
    SELECT c_custkey, TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 11 AS INTEGER)),
           TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 11 + 3 + c_custkey % 2 AS INTEGER)) FROM customer))"""


def _in_ranges(met: str) -> str:
    return f"""WITH {SESSIONS}, {USER_RANGES}
SELECT r.user_id, r."start", r."end",
       count(s.user_id) AS session_count, CAST(coalesce(sum(duration_seconds), 0) AS BIGINT) AS total_duration
FROM ranges r LEFT JOIN sess s ON s.user_id = r.user_id AND {met}
GROUP BY ALL"""


def _ranked(value: str) -> str:
    return f"""SELECT user_id, {value}, row_number() OVER (ORDER BY {value} DESC, user_id) AS number,
       rank() OVER (ORDER BY {value} DESC) AS rank, dense_rank() OVER (ORDER BY {value} DESC) AS dense
FROM ({_clv("hours_only")})"""


UNITS = "units AS (SELECT p_partkey AS product_id, CAST(50 + p_partkey * 37 % 900 AS BIGINT) AS stock FROM part)"

STOCK = f"""WITH {ITEMS}, {UNITS},
folded AS (
  SELECT product_id, count(*) AS demands,
         list_reduce(list_prepend(any_value(stock), list(quantity ORDER BY ship_date, transaction_id, line, quantity)),
                     lambda acc, x: CASE WHEN acc >= x THEN acc - x ELSE acc END) AS remaining,
         list_reduce(list_prepend(any_value(stock) * 1000000, list(quantity ORDER BY ship_date, transaction_id, line, quantity)),
                     lambda acc, x: CASE WHEN acc // 1000000 >= x THEN acc - x * 1000000 + 1 ELSE acc END) % 1000000 AS filled
  FROM items JOIN units USING (product_id) GROUP BY product_id),
stock AS (
  SELECT p_partkey AS product_id, stock AS initial_stock, coalesce(remaining, stock)::BIGINT AS remaining_stock,
         coalesce(filled, 0)::BIGINT AS filled, (coalesce(demands, 0) - coalesce(filled, 0))::BIGINT AS refused
  FROM part JOIN units u ON u.product_id = p_partkey LEFT JOIN folded f ON f.product_id = p_partkey)"""

SUBCATEGORIES = """subs AS (
  SELECT p_brand AS category_id, p_type AS sub_name,
         'sub_' || right(p_brand, 3) || '_' ||
         lpad(CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_type) - 1 AS VARCHAR), 2, '0') AS subcategory_id
  FROM (SELECT DISTINCT p_brand, p_type FROM part))"""

SESSION_CELLS = f"""WITH {SESSIONS},
timed AS (
  SELECT v.*, s.start_time, p_brand AS category_id,
         (coalesce(lead(us) OVER w, epoch_us(s.end_time)) - us) // 1000000 AS view_duration,
         row_number() OVER w - 1 AS pv
  FROM views v JOIN sess s USING (user_id, session_no) LEFT JOIN part ON p_partkey = v.product_id
  WINDOW w AS (PARTITION BY v.user_id, v.session_no ORDER BY v.ts, v.event_id)),
{VIEWED},
doc AS (
  SELECT s.*, {_key('s.user_id', 's.start_time')} AS row_key, ids, n_name, r_name
  FROM sess s LEFT JOIN viewed USING (user_id, session_no)
  LEFT JOIN customer ON c_custkey = s.user_id LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN region ON r_regionkey = n_regionkey),
cells AS (
  SELECT row_key, 'session_data' AS family, {_put('start_time', 'session_id')} AS put, unnest([
           {{'q': 'session_id', 'v': session_id}},
           {{'q': 'start_time', 'v': {_iso('start_time')}}},
           {{'q': 'end_time', 'v': {_iso('end_time')}}},
           {{'q': 'duration', 'v': CAST(duration_seconds AS VARCHAR)}},
           {{'q': 'geo_data', 'v': CASE WHEN n_name IS NULL THEN '' ELSE '{{"state":"' || n_name || '","country":"' || r_name || '"}}' END}},
           {{'q': 'device_profile', 'v': ''}},
           {{'q': 'viewed_products', 'v': '[' || coalesce(ids, '') || ']'}},
           {{'q': 'conversion_status', 'v': conversion_status}}]) AS cell
  FROM doc
  UNION ALL
  SELECT {_key('user_id', 'start_time')}, 'page_views',
         {_put('start_time', "printf('sess_%06d_%d', user_id, session_no)")}, unnest([
           {{'q': printf('pv_%d_timestamp', pv), 'v': {_iso('ts')}}},
           {{'q': printf('pv_%d_page_type', pv), 'v': page_type}},
           {{'q': printf('pv_%d_product_id', pv), 'v': coalesce(CAST(product_id AS VARCHAR), '')}},
           {{'q': printf('pv_%d_category_id', pv), 'v': coalesce(category_id, '')}},
           {{'q': printf('pv_%d_view_duration', pv), 'v': CAST(view_duration AS VARCHAR)}}])
  FROM timed)
SELECT row_key, family, cell.q AS qualifier, cell.v AS value, CAST(0 AS BIGINT) AS version, put FROM cells"""

CELL_SOURCE = """src AS (
  SELECT printf('user_%06d', user_id) AS row_key, 'metrics' AS family, event_type AS qualifier,
         CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS value, epoch_us(ts) AS version FROM events),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY version DESC, value DESC) AS n FROM src)"""


def _metric(name: str, sql: str, key: str, value: str, family: str, qualifier: str, money: bool) -> str:
    shown = f"CAST({value} AS DOUBLE)" if money else value
    return (
        f"SELECT CAST({key} AS VARCHAR) AS row_key, '{family}' AS family, '{qualifier}' AS qualifier, "
        f"CAST({shown} AS VARCHAR) AS value, '{name}' AS metric FROM ({sql})"
    )


METRICS = "\nUNION ALL\n".join(
    [
        _metric("products_metrics", TOP_PRODUCTS, "product_id", "total_revenue", "revenue", "total", True),
        _metric("sales_by_category", BY_CATEGORY_ORDER_TOTAL, "category_id", "total_revenue", "revenue", "total", True),
        _metric("revenue_by_category", BY_CATEGORY, "category_id", "total_revenue", "revenue", "total", True),
        _metric("sales_over_time", DAILY, "day", "total_revenue", "revenue", "total", True),
        _metric("funnel_metrics", FUNNEL, "conversion_status", "count", "metrics", "count", False),
        _metric("user_segmentation", SEGMENTS, "purchase_count", "user_count", "metrics", "user_count", False),
    ]
)

def _prices(key: str, name: str) -> str:
    return f"""
      WITH c AS (SELECT {key} AS k, l_shipdate AS date, l_extendedprice / l_quantity AS price
                 FROM lineitem JOIN part ON p_partkey = l_partkey),
      r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY date, price) AS seq, count(*) OVER (PARTITION BY k) AS n FROM c)
      SELECT k AS {name}, CAST(max(n) AS INTEGER) AS changes, max(CASE WHEN seq = 1 THEN price END) AS base_price,
             max(CASE WHEN seq = n THEN price END) AS current_price, min(date) AS creation_date,
             string_agg(CAST(CAST(floor(price) AS BIGINT) AS VARCHAR), ' ' ORDER BY seq) AS prices
      FROM r GROUP BY 1"""


CLASSIFIED = """docs AS (
  SELECT s.session_id, s.user_id, s.session_no, s.start_time, s.end_time, s.duration_seconds, CAST(s.views AS INTEGER) AS views,
         bool_or(v.page_type = 'purchase') AS reached,
         coalesce(bool_or(c.quantity > 0), false) AS has_cart
  FROM sess s JOIN views v USING (user_id, session_no)
  LEFT JOIN (SELECT user_id, session_no, sum(CAST(floor(value / 10) AS BIGINT)) AS quantity
             FROM views WHERE page_type = 'click' GROUP BY user_id, session_no, product_id) c USING (user_id, session_no)
  GROUP BY ALL)"""

NESTED_CELLS = f"""SELECT row_key, family, qualifier,
       CASE WHEN qualifier = 'viewed_products' AND value <> '[]'
              THEN '["' || replace(substr(value, 2, length(value) - 2), ',', '","') || '"]'
            WHEN qualifier LIKE 'pv\\_%\\_category\\_id' ESCAPE '\\' THEN ''
            WHEN qualifier LIKE 'pv\\_%\\_page\\_type' ESCAPE '\\' AND value = 'purchase' THEN 'checkout' ELSE value END AS value
FROM ({SESSION_CELLS}) WHERE qualifier NOT IN ('geo_data', 'device_profile', 'conversion_status')"""

ORACLE: dict[str, str] = {
    "top_products": TOP_PRODUCTS,
    "revenue_by_category": BY_CATEGORY,
    "revenue_by_category_order_total": BY_CATEGORY_ORDER_TOTAL,
    "lookup_products_nested": f"""WITH {ITEMS},
      known AS (SELECT p_partkey, count(*) AS n, min(p_brand) AS brand FROM part GROUP BY 1)
      SELECT transaction_id, line, product_id, quantity, subtotal,
             CAST(coalesce(n, 0) AS INTEGER) AS matches, brand AS category_id
      FROM items LEFT JOIN known ON p_partkey = product_id""",
    "revenue_by_state": BY_STATE + " LIMIT 10",
    "revenue_by_state_sql": BY_STATE,
    "daily_sales": DAILY,
    "order_totals": f"""WITH {ITEMS},
      t AS (SELECT transaction_id, CAST(sum(amount) AS DECIMAL(18,2)) AS subtotal,
                   max(CAST(l_discount AS DECIMAL(6,4))) AS rate FROM items GROUP BY 1),
      d AS (SELECT *, CAST(round(CAST(subtotal AS DECIMAL(18,2)) * rate, 2) AS DECIMAL(18,2)) AS discount FROM t)
      SELECT transaction_id, CAST(subtotal AS DOUBLE) AS subtotal, CAST(discount AS DOUBLE) AS discount,
             CAST(subtotal - discount AS DOUBLE) AS total FROM d""",
    "transactions_nested": f"""WITH {ITEMS},
      placed AS (SELECT *, row_number() OVER (PARTITION BY transaction_id
                   ORDER BY line, product_id, quantity, subtotal, ship_date) - 1 AS pos FROM items)
      SELECT transaction_id, o_custkey AS user_id, o_totalprice AS total,
             CAST(count(*) AS INTEGER) AS n_items,
             string_agg(CAST(product_id AS VARCHAR) || 'x' || CAST(quantity AS VARCHAR), ' ' ORDER BY pos) AS item_list
      FROM placed JOIN orders ON o_orderkey = transaction_id GROUP BY 1, 2, 3""",
    "explode_items": f"""WITH {ITEMS}
      SELECT transaction_id, o_custkey AS user_id, product_id, quantity, subtotal
      FROM items JOIN orders ON o_orderkey = transaction_id""",
    "null_defaults": """
      WITH seen AS (SELECT user_id, count(*) AS events, arg_max(event_type, ts) AS last_page, max(value) AS top_value
                    FROM events GROUP BY 1)
      SELECT c_custkey AS user_id, coalesce(events, 0) AS events, coalesce(last_page, 'none') AS last_page,
             coalesce(top_value, 0.0::DOUBLE) AS top_value
      FROM customer LEFT JOIN seen ON user_id = c_custkey""",
    "product_catalog": f"""WITH {SUBCATEGORIES}
      SELECT p_partkey AS product_id, p_name AS name, p_brand AS category_id, p_brand AS category_name,
             subcategory_id, sub_name AS subcategory_name
      FROM part LEFT JOIN subs ON category_id = p_brand AND right(subcategory_id, 3) = '_01'""",
    "category_tree": f"""WITH {SUBCATEGORIES}
      SELECT category_id, category_id AS category_name, subcategory_id, sub_name AS name FROM subs""",
    "price_timeline": """
      WITH c AS (SELECT l_partkey AS product_id, l_shipdate AS date, l_extendedprice / l_quantity AS price FROM lineitem)
      SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY date, price) AS seq FROM c""",
    "price_summary": """
      WITH c AS (SELECT l_partkey AS product_id, l_shipdate AS date, l_extendedprice / l_quantity AS price FROM lineitem),
      r AS (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY date, price) AS seq,
                   count(*) OVER (PARTITION BY product_id) AS changes FROM c)
      SELECT product_id, min(date) AS creation_date, max(CASE WHEN seq = 1 THEN price END) AS base_price,
             max(CASE WHEN seq = changes THEN price END) AS current_price, max(changes) AS changes
      FROM r GROUP BY 1""",
    "price_history_nested": _prices("l_partkey", "product_id"),
    "price_history_by_category": _prices("p_brand", "category_id"),
    "purchasable_products": STOCK + """
      SELECT product_id, p_name AS name, p_brand AS category_id, remaining_stock AS current_stock
      FROM stock JOIN part ON p_partkey = product_id WHERE p_size > 2 AND remaining_stock > 0""",
    "session_rollup": f"""WITH {SESSIONS}
      SELECT session_id, user_id, start_time, end_time, duration_seconds, views FROM sess""",
    "session_paths": f"""WITH {VIEWS},
      placed AS (SELECT *, row_number() OVER (PARTITION BY user_id, session_no ORDER BY ts, event_id) - 1 AS pos FROM views)
      SELECT printf('sess_%06d_%d', user_id, session_no) AS session_id, CAST(count(*) AS INTEGER) AS views, string_agg(page_type, '>' ORDER BY pos) AS path
      FROM placed GROUP BY user_id, session_no""",
    "checkout_sessions": f"""WITH {VIEWS}
      SELECT printf('sess_%06d_%d', user_id, session_no) AS session_id, bool_or(page_type = 'purchase') AS reached
      FROM views GROUP BY user_id, session_no""",
    "viewed_products": f"""WITH {VIEWS}, {VIEWED}
      SELECT printf('sess_%06d_%d', user_id, session_no) AS session_id, products, ids AS product_list FROM viewed""",
    "view_durations": f"""WITH {SESSIONS}
      SELECT event_id, v.user_id, page_type, ts,
             (coalesce(lead(us) OVER (PARTITION BY v.user_id, v.session_no ORDER BY ts, event_id),
                       epoch_us(s.end_time)) - us) // 1000000 AS view_duration
      FROM views v JOIN sess s USING (user_id, session_no)""",
    "view_category": f"""WITH {EVENTS}
      SELECT event_id, user_id, product_id, p_brand AS category_id FROM ev LEFT JOIN part ON p_partkey = product_id""",
    "cart_contents": f"""WITH {VIEWS},
      adds AS (SELECT *, CAST(floor(value / 10) AS BIGINT) AS q FROM views WHERE page_type = 'click'),
      entries AS (SELECT user_id, session_no, product_id, CAST(sum(q) AS BIGINT) AS quantity,
                         arg_min(value, ts) AS price FROM adds GROUP BY 1, 2, 3)
      SELECT printf('sess_%06d_%d', user_id, session_no) AS session_id, product_id, quantity, price
      FROM entries WHERE quantity > 0""",
    "session_conversion": f"""WITH {SESSIONS} SELECT session_id, user_id, conversion_status FROM sess""",
    "conversion_funnel": FUNNEL,
    "page_transitions": f"""WITH {VIEWS},
      steps AS (SELECT page_type AS next, lag(page_type) OVER
                  (PARTITION BY user_id, session_no ORDER BY ts, event_id) AS prev FROM views),
      pairs AS (SELECT prev, next, count(*) AS n FROM steps WHERE prev IS NOT NULL GROUP BY 1, 2)
      SELECT prev, next, n, n / CAST(sum(n) OVER (PARTITION BY prev) AS DOUBLE) AS share FROM pairs""",
    "user_sessions_range": f"""WITH {SESSIONS}
      SELECT {_key('user_id', 'start_time')} AS row_key, start_time, duration_seconds, views, conversion_status
      FROM sess WHERE user_id = 42 AND start_time > TIMESTAMP '2024-01-05' AND start_time <= TIMESTAMP '2024-01-15'""",
    "sessions_in_range": f"""WITH {SESSIONS}
      SELECT {_key('user_id', 'start_time')} AS row_key, start_time, duration_seconds
      FROM sess WHERE start_time > TIMESTAMP '2024-01-05' AND start_time <= TIMESTAMP '2024-01-25'""",
    "user_purchases": f"WITH {PURCHASES} SELECT user_id, total_spend, purchase_count FROM purchases",
    "user_summary": f"WITH {PURCHASES}, {SUMMARY} SELECT * FROM summaries",
    "purchase_segments": SEGMENTS,
    "distinct_users": "SELECT DISTINCT o_custkey AS user_id FROM orders",
    "user_engagement": f"WITH {SESSIONS}, {ENGAGED} SELECT * FROM engaged",
    "engagement_lenient": f"""WITH {SESSIONS},
      texts AS (SELECT user_id, CAST(duration_seconds AS VARCHAR) || CASE WHEN session_no % 7 = 0 THEN 's' ELSE '' END AS d FROM sess)
      SELECT user_id, count(*) AS session_count, CAST(sum(coalesce(TRY_CAST(d AS BIGINT), 0)) AS BIGINT) AS total_duration
      FROM texts GROUP BY 1""",
    "clv_current": _clv("current"),
    "clv_hours_only": _clv("hours_only"),
    "clv_top10": _clv("current", "ORDER BY clv DESC, user_id LIMIT 10"),
    "first_n_users": "SELECT c_custkey AS user_id, c_name AS name FROM customer ORDER BY c_custkey LIMIT 1000",
    "engagement_in_user_ranges": _in_ranges('start_time > r."start" AND start_time <= r."end"'),
    "engagement_during_user_ranges": _in_ranges('end_time > r."start" AND start_time <= r."end"'),
    "clv_ranked": _ranked("clv"),
    "purchase_ranks": _ranked("purchase_count"),
    "upserted_orders": """
      SELECT o_orderkey AS transaction_id, printf('order_%010d', o_orderkey) AS order_key, o_custkey AS user_id,
             CASE WHEN o_orderkey % 3 = 0 THEN 'checked' ELSE o_orderstatus END AS status, o_totalprice AS total
      FROM orders WHERE o_custkey % 2 = 0 OR o_orderkey % 3 = 0""",
    "folded_summaries": """
      SELECT printf('user_%06d', o_custkey) AS user_key, count(*) AS n,
             CAST(sum(CAST(o_totalprice AS DECIMAL(28,6))) AS DOUBLE) AS spend, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order
      FROM orders GROUP BY 1""",
    "checked_users": """
      WITH marked AS (SELECT c_custkey, n_name, c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 AS good FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey)
      SELECT 'good' AS kind, count(*) AS records, count(DISTINCT CASE WHEN n_name IS NOT NULL THEN c_custkey END) AS different FROM marked WHERE good
      UNION ALL
      SELECT 'bad', count(*), count(*) FROM marked WHERE NOT good""",
    "merge_update": """
      WITH last AS (SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS segment,
                           max(o_totalprice) AS balance FROM orders GROUP BY 1)
      SELECT c_custkey AS user_id, c_name AS name, coalesce(segment, c_mktsegment) AS segment,
             coalesce(balance, c_acctbal) AS balance
      FROM customer LEFT JOIN last ON o_custkey = c_custkey""",
    "session_cells": SESSION_CELLS,
    "session_cells_in_range": f"""SELECT * FROM ({SESSION_CELLS})
      WHERE row_key >= printf('user_%06d:%d', 42, (999999999999000000 - epoch_us(TIMESTAMP '2024-01-15')) // 1000000)
        AND row_key < printf('user_%06d:%d', 42, (999999999999000000 - epoch_us(TIMESTAMP '2024-01-05')) // 1000000)""",
    "engagement_from_cells": f"""WITH {SESSIONS}, {ENGAGED}
      SELECT printf('user_%06d', user_id) AS user_id, session_count, total_duration FROM engaged""",
    "wide_rows": f"""WITH {EVENTS},
      writes AS (
        SELECT ev.*, w AS version, date_trunc('day', ts) AS day FROM ev, (SELECT unnest([0, 1, 2]) AS w)
        WHERE w = 0 OR event_id % (w + 1) = 0),
      best AS (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY version DESC, us DESC, event_id DESC) AS n FROM writes)
      SELECT {_key('user_id', 'day')} AS row_key, CAST(event_id AS VARCHAR) AS event, page_type AS page FROM best WHERE n = 1""",
    "users_from_json": """
      SELECT printf('user_%06d', c_custkey) AS user_id, n_name AS state, r_name AS country
      FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""",
    "catalog_from_json": f"""WITH {SUBCATEGORIES}, counts AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1)
      SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_brand AS category_id, subcategory_id,
             CAST(n AS INTEGER) AS changes
      FROM part LEFT JOIN subs ON category_id = p_brand AND right(subcategory_id, 3) = '_01'
      LEFT JOIN counts ON l_partkey = p_partkey""",
    "transactions_from_json": f"""WITH {ITEMS}
      SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, o_totalprice AS total, o_orderstatus AS status,
             row_number() OVER (PARTITION BY transaction_id ORDER BY line, CAST(product_id AS VARCHAR), quantity, subtotal) - 1 AS n,
             CAST(product_id AS VARCHAR) AS product_id, quantity, subtotal
      FROM items JOIN orders ON o_orderkey = transaction_id""",
    "classified_sessions": f"""WITH {SESSIONS}, {CLASSIFIED}
      SELECT session_id, views, CASE WHEN has_cart AND reached THEN 'converted' WHEN has_cart THEN 'abandoned'
             ELSE 'browsed' END AS conversion_status FROM docs""",
    "nested_session_cells": NESTED_CELLS,
    "unassigned_events": """
      SELECT event_type AS page_type, count(*) AS events, count(*) FILTER (WHERE user_id IS NULL OR ts IS NULL) AS lost
      FROM events GROUP BY 1""",
    "latest_cells": f"WITH {CELL_SOURCE} SELECT row_key, family, qualifier, value, version FROM ranked WHERE n = 1",
    "retained_versions": f"WITH {CELL_SOURCE} SELECT row_key, family, qualifier, value, version FROM ranked WHERE n <= 3",
    "metric_cells": METRICS,
    "stock_depletion": STOCK + " SELECT * FROM stock",
    "filled_demands": f"""WITH {ITEMS}, {UNITS},
      lists AS (
        SELECT product_id, any_value(stock) AS stock, list(struct_pack(left_over := 0::BIGINT, quantity := quantity, flags := []::BOOLEAN[])
                                ORDER BY ship_date, transaction_id, line, quantity) AS asks,
               list(struct_pack(t := transaction_id, l := line, q := quantity, d := ship_date)
                    ORDER BY ship_date, transaction_id, line, quantity) AS lines
        FROM items JOIN units USING (product_id) GROUP BY 1),
      folded AS (
        SELECT product_id, lines, list_reduce(
          list_prepend(struct_pack(left_over := stock, quantity := 0::BIGINT, flags := []::BOOLEAN[]), asks),
          lambda acc, x: struct_pack(
            left_over := acc.left_over - CASE WHEN acc.left_over >= x.quantity THEN x.quantity ELSE 0 END,
            quantity := 0::BIGINT, flags := list_append(acc.flags, acc.left_over >= x.quantity))).flags AS flags
        FROM lists),
      flat AS (SELECT product_id, unnest(lines) AS a, unnest(flags) AS ok FROM folded)
      SELECT a.t AS transaction_id, a.l AS line, product_id, a.q AS quantity, a.d AS ship_date FROM flat WHERE ok""",
    "remaining_stock": STOCK + " SELECT CAST(sum(remaining_stock) AS BIGINT) AS remaining FROM stock",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS name, count(*) AS rows FROM {t}"
        for t in ("customer", "part", "orders", "lineitem", "events", "nation", "region")
    ),
    "text_functions": """
      SELECT p_partkey AS product_id,
             array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title,
             printf('prod_%05d', p_partkey) AS padded, 'sub_' || right(p_brand, 3) || '_01' AS subcategory
      FROM part""",
    "time_functions": f"""WITH {EVENTS},
      e AS (SELECT *, ts + to_seconds(product_id) AS ts2 FROM ev)
      SELECT event_id, us AS micros, {_iso('ts')} AS iso, {_iso('ts2')} AS later,
             {_key('user_id', 'ts')} AS row_key, least(3, CAST(floor(value / 10) AS INTEGER)) AS take FROM e""",
    "map_lookup": """
      SELECT user_id, count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
             count(*) FILTER (WHERE event_type = 'refund') AS refunds FROM events GROUP BY 1""",
    "json_roundtrip": f"""WITH {EVENTS}
      SELECT event_id, product_id AS k, printf('{{"k":%d}}', product_id) AS json FROM ev""",
    "csv_export": ORDERS,
    "json_export": ORDERS,
    "append_table": f"{ORDERS} UNION ALL {ORDERS}",
    "ensure_table": ORDERS,
}

# The same rows as from one table.
ORACLE["wide_rows_of_runs"] = ORACLE["wide_rows"]
