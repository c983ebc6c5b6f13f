"""Whole-population distributions per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from usagelake.functions.expressions import duration_bucket, hour_of


def group_interest(sessions: DataFrame) -> DataFrame:
    """Sessions per date x kind -> ``date, kind, n``."""
    return sessions.groupBy("date", "kind").agg(F.count("*").alias("n"))


def group_province(facts: DataFrame) -> DataFrame:
    """Reports per date x province -> ``date, province, n``."""
    return facts.groupBy("date", "province").agg(F.count("*").alias("n"))


def group_usage_bucket(facts: DataFrame, unit: str = "ms") -> DataFrame:
    """Reports per date x bucket of the report's total milliseconds.

    ``unit="ms"`` (default, historical parity) feeds milliseconds to the
    second thresholds; ``unit="ms_as_s"`` converts to seconds first.
    -> ``date, bucket, n``.
    """
    return (facts.select("date", duration_bucket("duration_ms", unit).alias("bucket"))
            .groupBy("date", "bucket").agg(F.count("*").alias("n")))


def group_hour_profile(sessions: DataFrame, tz: str = "UTC") -> DataFrame:
    """Sessions per date x hour of ``begin_time`` -> ``date, hour, n``."""
    return (sessions.select("date", hour_of("begin_time", tz).alias("hour"))
            .groupBy("date", "hour").agg(F.count("*").alias("n")))


def conditional_share(df: DataFrame, predicate: Column) -> DataFrame:
    """Global count of rows meeting ``predicate`` and of all rows -> ``hits, total``.

    A global aggregate: each task counts its rows, only partial counts move.
    """
    return df.agg(F.count_if(predicate).cast("bigint").alias("hits"),
                  F.count("*").alias("total"))
