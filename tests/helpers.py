"""Hand-made reports for edge-case tests."""

from pyspark.sql import functions as F

from usagelake.operators.model import REPORT_COLUMNS

REPORT_SCHEMA = (
    "report_id string, ingest_seq bigint, user_id string, province string, city string, "
    "date string, brand string, model string, language string, system_version string, "
    "resolution string, net_status string, isp string, "
    "apps array<struct<package_name:string,begin_time:bigint,end_time:bigint,"
    "version:string,kind:string>>"
)

BASE_MS = 1520640000000  # 2018-03-10 00:00:00 UTC


def report(rid, seq, user, date, apps, province="P", brand="B", net="wifi"):
    return (rid, seq, user, province, "C", date, brand, "M", "zh", "7.0", "1080x1920", net, "X",
            [(p, b, e, v, k) for (p, b, e, v, k) in apps])


def reports_df(spark, rows):
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


__all__ = ["BASE_MS", "REPORT_COLUMNS", "F", "report", "reports_df", "rows"]
