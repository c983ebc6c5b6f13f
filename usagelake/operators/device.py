"""Device-attribute counts per day (report grain)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# The device dimensions counted per date, in table order.
DEVICE_DIMENSIONS = ("brand", "model", "system_version", "resolution", "net_status", "isp")


def device_counts(facts: DataFrame, dimension: str) -> DataFrame:
    """Reports per ``date`` x ``dimension`` value -> ``date, <dimension>, n``."""
    if dimension not in DEVICE_DIMENSIONS:
        raise ValueError(f"unknown device dimension {dimension!r}")
    return facts.groupBy("date", dimension).agg(F.count("*").alias("n"))


def device_counts_all(facts: DataFrame) -> DataFrame:
    """All six dimensions in one scan and one shuffle.

    ``unpivot`` becomes an Expand of six rows per report feeding a single
    partial aggregate, instead of six scans and six shuffles.
    """
    long = facts.unpivot(["date"], list(DEVICE_DIMENSIONS), "dimension", "value")
    return long.groupBy("date", "dimension", "value").agg(F.count("*").alias("n"))
