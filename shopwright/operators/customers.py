"""Per-user purchases, engagement and lifetime value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopwright.functions import amount, epoch_micros, money_sum
from shopwright.operators.intervals import in_ranges, overlapping
from shopwright.operators.sessions import sessions_in_range

CLV_COLUMNS = (
    "user_id",
    "total_spend",
    "purchase_count",
    "session_count",
    "total_duration",
    "tenure_days",
    "engagement_score",
    "clv",
)


def first_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first n rows in a stated order."""
    return df.orderBy(*order).limit(n)


def distinct_users(df: DataFrame) -> DataFrame:
    return df.select("user_id").distinct()


def purchase_totals(transactions: DataFrame) -> DataFrame:
    """user_id, total_spend, purchase_count."""
    return transactions.groupBy("user_id").agg(
        amount(money_sum("total")).alias("total_spend"),
        F.count("*").alias("purchase_count"),
    )


def merge_update(
    target: DataFrame, updates: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """Set ``columns`` in target rows whose key is in ``updates``; never insert.

    ``updates`` has at most one row per key.
    """
    fresh = updates.select(
        key, F.lit(True).alias("__hit"), *[F.col(c).alias(f"__new_{c}") for c in columns]
    )
    return (
        target.join(fresh, key, "left")
        .withColumns({c: F.when(F.col("__hit"), F.col(f"__new_{c}")).otherwise(F.col(c)) for c in columns})
        .select(*target.columns)
    )


def with_empty_summary(users: DataFrame) -> DataFrame:
    """Users with a purchase summary of zeros."""
    return users.withColumn(
        "summary",
        F.struct(
            F.lit(0).cast("bigint").alias("total_purchases"), F.lit(0.0).alias("avg_spend")
        ),
    )


def user_summary(users: DataFrame, transactions: DataFrame) -> DataFrame:
    """Users with purchase count and average spend; zeros where a user bought nothing."""
    totals = transactions.groupBy("user_id").agg(
        F.count("*").alias("n"), amount(money_sum("total")).alias("spend")
    )
    summary = F.struct(
        F.col("n").alias("total_purchases"),
        F.coalesce(F.col("spend") / F.col("n"), F.lit(0.0)).alias("avg_spend"),
    )
    return merge_update(
        with_empty_summary(users), totals.select("user_id", summary.alias("summary")), "user_id", ["summary"]
    )


def purchase_segments(users: DataFrame) -> DataFrame:
    """Number of users per purchase count, from users with a summary."""
    return (
        users.groupBy(F.col("summary.total_purchases").alias("purchase_count"))
        .agg(F.count("*").alias("user_count"))
        .orderBy("purchase_count")
    )


def engagement_totals(sessions: DataFrame, duration: str = "duration_seconds") -> DataFrame:
    """Sessions and seconds per user. A duration that is no whole number counts as 0 seconds."""
    seconds = F.coalesce(F.col(duration).try_cast("bigint"), F.lit(0))
    return sessions.groupBy("user_id").agg(
        F.count("*").alias("session_count"), F.sum(seconds).alias("total_duration")
    )


def with_all_users(users: DataFrame, totals: DataFrame) -> DataFrame:
    """Engagement totals of exactly the given users, zeros where there are none."""
    return (
        users.select("user_id")
        .join(totals, "user_id", "left")
        .na.fill(0, ["session_count", "total_duration"])
    )


def engagement(
    users: DataFrame, sessions: DataFrame, start, end, duration: str = "duration_seconds"
) -> DataFrame:
    """Sessions and seconds of every user in a time range, zeros included."""
    totals = engagement_totals(sessions_in_range(sessions, start, end), duration)
    return with_all_users(users, totals)


def engagement_in_ranges(
    ranges: DataFrame, sessions: DataFrame, duration: str = "duration_seconds", during: str | None = None
) -> DataFrame:
    """Sessions and seconds in every range (user_id, start, end) of each user's own, zeros included.

    A session counts by its start (start < t <= end), or, where ``during`` names the column of its end, if any time of it
    lies in the range. Equal ranges count once; one that is empty or has a null has no sessions.
    """
    own = ranges.select("user_id", "start", "end").distinct()
    rows = sessions.select("user_id", "start_time", duration, *([during] if during else []))
    if during is None:
        found = in_ranges(rows, own, ["user_id"], "start_time", "start", "end")
    else:
        open_time = epoch_micros("start_time"), epoch_micros(during)
        found = overlapping(rows, own, ["user_id"], open_time, (epoch_micros("start") + 1, epoch_micros("end")))
    seconds = F.coalesce(F.col(duration).try_cast("bigint"), F.lit(0))
    totals = found.groupBy("user_id", "start", "end").agg(
        F.count("*").alias("session_count"), F.sum(seconds).alias("total_duration")
    )
    return own.join(totals, ["user_id", "start", "end"], "left").na.fill(0, ["session_count", "total_duration"])


def customer_lifetime_value(
    users: DataFrame,
    purchases: DataFrame | None,
    engagement: DataFrame,
    as_of,
    mode: str = "current",
) -> DataFrame:
    """Customers ranked by lifetime value.

    mode ``current`` scores engagement by sessions per month and hours;
    ``hours_only`` by hours alone. ``as_of`` is the day tenure is counted to.
    ``purchases`` is None where ``users`` has total_spend and purchase_count already.
    """
    if mode not in ("current", "hours_only"):
        raise ValueError(f"unknown mode {mode!r}")
    day: Column = F.lit(as_of).cast("date")
    known = users
    if purchases is not None:
        known = users.select("user_id", "registration_date").join(purchases, "user_id", "left")
    joined = (
        known.join(engagement, "user_id", "left")
        .na.fill(0, ["total_spend", "purchase_count", "session_count", "total_duration"])
    )
    hours = F.col("total_duration") / F.lit(3600.0)
    months = F.col("tenure_days") / F.lit(30.0)
    monthly = F.try_divide("session_count", months) / F.lit(10.0)
    average = F.when(
        F.col("purchase_count") > 0, F.try_divide("total_spend", "purchase_count")
    ).otherwise(F.lit(0.0))
    value = average * F.col("session_count") * F.col("engagement_score")
    return (
        joined.withColumn("tenure_days", F.datediff(day, F.col("registration_date")))
        .withColumn("engagement_score", monthly + hours if mode == "current" else hours)
        .withColumn("clv", F.coalesce(value, F.lit(0.0)))
        .select(*CLV_COLUMNS)
        .orderBy(F.desc("clv"), "user_id")
    )
