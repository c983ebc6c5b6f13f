"""Per-app metrics (session grain unless stated)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from usagelake.functions.expressions import duration_bucket, hour_of, trunc_seconds, week_of_month


def app_launches(sessions: DataFrame) -> DataFrame:
    """Sessions per package x date -> ``package_name, date, n``."""
    return sessions.groupBy("package_name", "date").agg(F.count("*").alias("n"))


def app_daily_users(sessions: DataFrame) -> DataFrame:
    """Distinct users per package x date, one row each."""
    return sessions.select("package_name", "date", "user_id").distinct()


def app_daily_user_count(sessions: DataFrame) -> DataFrame:
    """Number of distinct users per package x date -> ``package_name, date, users``."""
    return (app_daily_users(sessions).groupBy("package_name", "date")
            .agg(F.count("*").alias("users")))


def sketch_estimate(sketch: str) -> "F.Column":
    """Distinct members of a sketch; the same for the same members, in however many batches they came.

    A sketch that was never merged would be read by another estimator, one that
    depends on the order of arrival; merging it with itself avoids that.
    """
    return F.hll_sketch_estimate(F.hll_union(sketch, sketch))


def app_daily_user_sketch(sessions: DataFrame, lg_k: int = 12) -> DataFrame:
    """HyperLogLog sketch of the users per package x date -> ``package_name, date, sketch``.

    One small value per group, built map-side: no row per user is shuffled.
    Sketches of several batches merge with ``hll_union_agg``.
    """
    return sessions.groupBy("package_name", "date").agg(F.hll_sketch_agg("user_id", F.lit(lg_k)).alias("sketch"))


def app_daily_user_estimate(sketches: DataFrame) -> DataFrame:
    """Merged sketches (of any number of batches) read as ``package_name, date, users``."""
    merged = sketches.groupBy("package_name", "date").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("package_name", "date", sketch_estimate("sketch").alias("users"))


USER_PAGES = 64


def page_of(key, pages: int) -> "F.Column":
    """Deterministic page in ``0 .. pages-1`` from the first 32 bits of md5(key)."""
    h = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(pages))


def app_daily_users_text(sessions: DataFrame, pages: int = USER_PAGES) -> DataFrame:
    """The comma-joined user list per package x date, in pages.

    A user's page is a hash of the user id modulo ``pages``, whatever the
    group's size, so a page keeps its users when a group grows; only pages
    that hold users appear.  Raise ``pages`` for packages with very many daily
    users.  Users are sorted within a page.
    -> ``package_name, date, page, users_text``.
    """
    return sessions.groupBy("package_name", "date", page_of(F.col("user_id"), pages).alias("page")).agg(
        F.array_join(F.sort_array(F.collect_set("user_id")), ",").alias("users_text"))


def app_version_index(sessions: DataFrame) -> DataFrame:
    """Versions seen per package -> ``package_name, version``."""
    return sessions.select("package_name", "version").distinct()


def app_version_launches(sessions: DataFrame) -> DataFrame:
    """Sessions per package x version x date -> ``package_name, version, date, n``."""
    return sessions.groupBy("package_name", "version", "date").agg(F.count("*").alias("n"))


def app_duration_seconds(sessions: DataFrame) -> DataFrame:
    """Seconds per package x date, each session truncated before the sum."""
    return sessions.groupBy("package_name", "date").agg(
        F.sum(trunc_seconds()).cast("bigint").alias("seconds"))


def report_app_seconds(sessions: DataFrame) -> DataFrame:
    """Seconds of each package within each report -> ``report_id, date, package_name, seconds``."""
    return sessions.groupBy("report_id", "date", "package_name").agg(
        F.sum(trunc_seconds()).cast("bigint").alias("seconds"))


def app_usage_buckets(sessions: DataFrame) -> DataFrame:
    """Reports per package x bucket x date, bucketing a report's seconds in the package.

    -> ``package_name, bucket, date, n``.  Two aggregations; the first is
    partial-aggregated map-side so a huge report never lands whole in a task.
    """
    per = report_app_seconds(sessions)
    return (per.select("package_name", "date", duration_bucket("seconds", "s").alias("bucket"))
            .groupBy("package_name", "bucket", "date").agg(F.count("*").alias("n")))


def app_hour_profile(sessions: DataFrame, tz: str = "UTC") -> DataFrame:
    """Sessions per package x hour of ``begin_time`` (dates pooled)."""
    return (sessions.select("package_name", hour_of("begin_time", tz).alias("hour"))
            .groupBy("package_name", "hour").agg(F.count("*").alias("n")))


def app_week_profile(sessions: DataFrame, tz: str = "UTC") -> DataFrame:
    """Sessions per package x week of month of ``begin_time`` (dates pooled)."""
    return (sessions.select("package_name", week_of_month("begin_time", tz).alias("week_of_month"))
            .groupBy("package_name", "week_of_month").agg(F.count("*").alias("n")))
