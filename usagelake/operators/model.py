"""The two grains every metric is computed from.

``sessions`` has one row per app session with the report's attributes;
``facts`` has one row per report with its session count and total
milliseconds.  Report-grain metrics read ``facts`` so that reports with an
empty ``apps`` list still count; session-grain metrics read ``sessions``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

REPORT_COLUMNS = (
    "report_id", "ingest_seq", "user_id", "province", "city", "date", "brand", "model",
    "language", "system_version", "resolution", "net_status", "isp",
)
APP_FIELDS = ("package_name", "begin_time", "end_time", "version", "kind")


def explode_sessions(reports: DataFrame) -> DataFrame:
    """One row per element of ``apps``; ``session_seq`` is its array position."""
    cols = [c for c in REPORT_COLUMNS if c in reports.columns]
    x = reports.select(*cols, F.posexplode("apps").alias("session_seq", "app"))
    return x.select(*cols, F.col("session_seq").cast("bigint").alias("session_seq"),
                    *[F.col("app." + f).alias(f) for f in APP_FIELDS])


def facts_from_reports(reports: DataFrame) -> DataFrame:
    """Report grain straight from the nested array: no shuffle."""
    cols = [c for c in REPORT_COLUMNS if c in reports.columns]
    total = F.aggregate("apps", F.lit(0).cast("bigint"),
                        lambda acc, a: acc + (a["end_time"] - a["begin_time"]))
    return reports.select(*cols, F.size("apps").cast("bigint").alias("sessions"),
                          total.alias("duration_ms"))


def facts_from_sessions(sessions: DataFrame) -> DataFrame:
    """Report grain from long rows (partial + final hash aggregation)."""
    cols = [c for c in REPORT_COLUMNS if c in sessions.columns]
    return sessions.groupBy(*cols).agg(
        F.count("*").alias("sessions"),
        F.sum(F.col("end_time") - F.col("begin_time")).cast("bigint").alias("duration_ms"))


def nest_reports(sessions: DataFrame) -> DataFrame:
    """Long rows back to nested reports, sessions ordered by ``session_seq``.

    Each group is one report: one phone's document for a day.
    """
    cols = [c for c in REPORT_COLUMNS if c in sessions.columns]
    app = F.struct("session_seq", *APP_FIELDS)
    g = sessions.groupBy(*cols).agg(F.sort_array(F.collect_list(app)).alias("_apps"))
    strip = F.transform("_apps", lambda a: F.struct(*[a[f].alias(f) for f in APP_FIELDS]))
    return g.select(*cols, strip.alias("apps"))


@dataclass
class Usage:
    """A pair of DataFrames at session and report grain over the same reports."""

    sessions: DataFrame
    facts: DataFrame

    @classmethod
    def from_reports(cls, reports: DataFrame) -> "Usage":
        return cls(explode_sessions(reports), facts_from_reports(reports))

    @classmethod
    def from_sessions(cls, sessions: DataFrame) -> "Usage":
        return cls(sessions, facts_from_sessions(sessions))
