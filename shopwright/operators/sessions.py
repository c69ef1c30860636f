"""Sessions: from clicks to sessions, carts, funnels, transitions and lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopwright.functions import epoch_micros, whole_seconds
from shopwright.operators.nesting import nest, unnest
from shopwright.operators.ordered import PROBE, Heavy, ordered, resolve_heavy
from shopwright.shared import stored

# The page types that mean a visitor reached the till.
CHECKOUT_PAGES = ("checkout", "confirmation")

GAP_SECONDS = 6 * 3600

_MERGE = {"sum": F.sum, "min": F.min, "max": F.max}


def session_slots(
    events: DataFrame,
    measures: Mapping[str, tuple[str, Column]] | None = None,
    gap_seconds: int = GAP_SECONDS,
) -> DataFrame:
    """Activity per user and time slot, with the number of the session it belongs to.

    A session ends where a user pauses for longer than the gap. Slots are exactly
    one gap wide, so events of one slot always share a session, and a plain
    aggregation reduces any number of events to one row per user and slot. Only
    these rows enter the window, and a user has no more of them than the calendar
    has slots. Events without a user or time are left to :func:`unassigned_events`.

    ``measures`` maps a column to ("sum" | "min" | "max", expression).
    """
    gap = gap_seconds * 1_000_000
    us = epoch_micros("ts")
    measures = dict(measures or {})
    slots = (
        events.filter(F.col("user_id").isNotNull() & F.col("ts").isNotNull())
        .withColumn("__us", us)
        .groupBy("user_id", (F.col("__us") - F.pmod("__us", F.lit(gap))).alias("slot"))
        .agg(
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
            *[_MERGE[how](value).alias(name) for name, (how, value) in measures.items()],
        )
    )
    by_user = Window.partitionBy("user_id").orderBy("slot")
    idle = epoch_micros("first_ts") - F.lag(epoch_micros("last_ts")).over(by_user)
    so_far = by_user.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        slots.withColumn("__new", F.when(idle <= gap, 0).otherwise(1))
        .withColumn("session_no", F.sum("__new").over(so_far).cast("bigint"))
        .drop("__new")
    )


def events_for_sessions_after(events: DataFrame, start, gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """Events that tell all sessions which begin after ``start``.

    An earlier event than one gap before ``start`` cannot be in a session that begins
    later. The comparison reaches the file scan. Numbers of sessions are those in the rest.
    """
    zone = events.schema["ts"].dataType.simpleString()
    bound = F.lit(start).cast("timestamp") - F.make_interval(secs=F.lit(gap_seconds))
    return events.filter(F.col("ts") >= bound.cast(zone))


def sessions_from_events(
    events: DataFrame,
    measures: Mapping[str, tuple[str, Column]] | None = None,
    gap_seconds: int = GAP_SECONDS,
) -> DataFrame:
    """One row per session: user_id, session_no, start_time, end_time, duration_seconds, measures."""
    measures = dict(measures or {})
    return (
        session_slots(events, measures, gap_seconds)
        .groupBy("user_id", "session_no")
        .agg(
            F.min("first_ts").alias("start_time"),
            F.max("last_ts").alias("end_time"),
            *[_MERGE[how](name).alias(name) for name, (how, _) in measures.items()],
        )
        .withColumn(
            "duration_seconds",
            whole_seconds(epoch_micros("end_time") - epoch_micros("start_time")),
        )
    )


def unassigned_events(events: DataFrame) -> DataFrame:
    """Events that can't belong to a session, for want of a user or a time."""
    return events.filter(F.col("user_id").isNull() | F.col("ts").isNull())


def assign_sessions(
    events: DataFrame,
    tie: str,
    gap_seconds: int = GAP_SECONDS,
    *,
    heavy: Heavy = PROBE,
) -> DataFrame:
    """Every event with session_no and its session's start and end.

    Ordinary users: one shuffle by user, then windows. Users with a heavy share
    of the events are never gathered; their events look up the slot table, which
    is bounded by the calendar. It is written out first: otherwise the join would
    take over its partitioning by user and send a whole user to one task. Under
    Spark's broadcast threshold the events stay where they are; above it the join
    shuffles by user and slot and a hot slot is split.
    """
    events = events.filter(F.col("user_id").isNotNull() & F.col("ts").isNotNull())
    cut = resolve_heavy(events, ["user_id"], heavy)
    light = events if cut is None else events.filter(~cut)
    gap = gap_seconds * 1_000_000
    by_user = Window.partitionBy("user_id").orderBy("ts", tie)
    so_far = by_user.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("user_id", "session_no")
    idle = epoch_micros("ts") - F.lag(epoch_micros("ts")).over(by_user)
    out = (
        light.withColumn("__new", F.when(idle <= gap, 0).otherwise(1))
        .withColumn("session_no", F.sum("__new").over(so_far).cast("bigint"))
        .withColumns(
            {"session_start": F.min("ts").over(whole), "session_end": F.max("ts").over(whole)}
        )
        .drop("__new")
    )
    if cut is None:
        return out
    busy = events.filter(cut)
    slots = (
        session_slots(busy, gap_seconds=gap_seconds)
        .withColumns(
            {"session_start": F.min("first_ts").over(whole), "session_end": F.max("last_ts").over(whole)}
        )
        .select("user_id", "slot", "session_no", "session_start", "session_end")
    )
    us = epoch_micros("ts")
    looked_up = busy.withColumn("slot", us - F.pmod(us, F.lit(gap))).join(
        stored(slots, "slots"), ["user_id", "slot"]
    )
    return out.unionByName(looked_up.drop("slot"))


def view_durations(
    page_views: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    end: str,
    *,
    position: str | None = None,
    heavy: Heavy = PROBE,
) -> DataFrame:
    """Seconds on each page: up to the next view, or up to the session's end for the last.

    ``position`` names the number of the view in its session, from 1.
    """
    following = ordered(
        page_views, keys, order, leads={"__next": order[0]}, position=position, heavy=heavy
    )
    until = F.coalesce("__next", end)
    return following.withColumn(
        "view_duration", whole_seconds(epoch_micros(until) - epoch_micros(order[0]))
    ).drop("__next")


def view_category(page_views: DataFrame, products: DataFrame) -> DataFrame:
    """Page views with the category of the product they show, null where there is none.

    ``products`` has one row per product. It is joined as it is: an aggregation in
    between would keep Spark from splitting the views of a very popular product.
    """
    known = products.select("product_id", "category_id")
    return page_views.drop("category_id").join(known, "product_id", "left")


def page_transitions(
    page_views: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    heavy: Heavy = PROBE,
) -> DataFrame:
    """How often one page type follows another, and the share among all that follow it."""
    steps = ordered(page_views, keys, order, lags={"prev": "page_type"}, heavy=heavy)
    counted = (
        steps.filter(F.col("prev").isNotNull())
        .groupBy("prev", F.col("page_type").alias("next"))
        .agg(F.count("*").alias("n"))
    )
    # One row per pair of page types by now.
    return counted.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("prev")))


def session_paths(
    page_views: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    fields: Sequence[str],
    *,
    heavy: Heavy = PROBE,
) -> DataFrame:
    """Page views nested per session in viewing order."""
    return nest(page_views, keys, order, fields, "page_views", heavy=heavy)


def viewed_products(page_views: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct products viewed per session, sorted, as one array.

    Duplicates collapse before the shuffle; an array is no longer than the catalogue.
    """
    seen = page_views.filter(F.col("product_id").isNotNull())
    return seen.groupBy(*keys).agg(F.array_sort(F.collect_set("product_id")).alias("viewed_products"))


def cart_entries(adds: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Cart lines from add-to-cart rows: summed quantity, price of the first add."""
    return adds.groupBy(*keys, "product_id").agg(
        F.sum("quantity").cast("bigint").alias("quantity"),
        F.min_by("price", F.struct(*order)).alias("price"),
    )


def cart_contents(entries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cart lines as one map from product id to {quantity, price}, without empty lines.

    ``entries`` has one row per session and product, so a map is no larger than the
    catalogue. A session whose lines are all empty keeps its row with an empty map.
    """
    line = F.struct("product_id", F.struct("quantity", "price").alias("line"))
    full = F.map_from_entries(F.array_sort(F.collect_list(line))).alias("cart_contents")
    return drop_empty_cart_lines(entries.groupBy(*keys).agg(full))


def drop_empty_cart_lines(sessions: DataFrame) -> DataFrame:
    return sessions.withColumn(
        "cart_contents", F.map_filter("cart_contents", lambda _, line: line["quantity"] > 0)
    )


def reached_checkout(page_views: str = "page_views", pages: Sequence[str] = CHECKOUT_PAGES) -> Column:
    """Whether any page of a nested session is a checkout page."""
    return F.exists(page_views, lambda v: v["page_type"].isin(*pages))


def conversion_status(converted: Column, has_cart: Column) -> Column:
    """converted, abandoned or browsed. Pass the cart as it was before empty lines were dropped."""
    return (
        F.when(converted, F.lit("converted"))
        .when(has_cart, F.lit("abandoned"))
        .otherwise(F.lit("browsed"))
    )


def classify_conversion(sessions: DataFrame, keys: Sequence[str] = ("session_id",)) -> DataFrame:
    """Status of nested sessions: a cart taken to the checkout counts as converted.

    Sessions in several parts (column ``part``) are judged over all of them, and
    every part gets the session's status.
    """
    has_cart = F.coalesce(F.size("cart_contents") > 0, F.lit(False))
    reached = F.coalesce(reached_checkout(), F.lit(False))
    if "part" not in sessions.columns:
        return sessions.withColumn("conversion_status", conversion_status(has_cart & reached, has_cart))
    over_all = sessions.groupBy(*keys).agg(F.max(has_cart).alias("__cart"), F.max(reached).alias("__reached"))
    status = conversion_status(F.col("__cart") & F.col("__reached"), F.col("__cart"))
    known = over_all.select(*keys, status.alias("conversion_status"))
    return sessions.drop("conversion_status").join(known, list(keys))


def conversion_funnel(sessions: DataFrame) -> DataFrame:
    """Number of sessions per conversion status; the parts of a session count once."""
    whole = sessions.filter("part = 0") if "part" in sessions.columns else sessions
    return whole.groupBy("conversion_status").agg(F.count("*").alias("count"))


def in_time_range(ts: str, start, end) -> Column:
    """After ``start``, up to and including ``end``; a bare date is its midnight.

    The column is left bare so that the comparison reaches the file scan.
    """
    return (F.col(ts) > F.lit(start)) & (F.col(ts) <= F.lit(end))


def sessions_in_range(sessions: DataFrame, start, end) -> DataFrame:
    return sessions.filter(in_time_range("start_time", start, end))


def user_sessions(
    sessions: DataFrame, user_id, start, end, tie: Sequence[str] = ("session_id",)
) -> DataFrame:
    """One user's sessions in a time range, newest first; ties go to the smaller key."""
    found = sessions_in_range(sessions.filter(F.col("user_id") == user_id), start, end)
    return found.orderBy(F.desc("start_time"), *tie)


def explode_page_views(sessions: DataFrame) -> DataFrame:
    """Long page views of nested sessions with their position ``pv`` from 0."""
    return unnest(sessions.select("session_id", "user_id", "start_time", "page_views"), "page_views", index="pv")
