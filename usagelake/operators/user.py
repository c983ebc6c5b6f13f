"""Per-user metrics.

``user_interest`` accumulates.  The ``user_day_*`` metrics overwrite: a later
report of the same user and date replaces the earlier value, so they read the
last report of each user-day, ordered by ``(ingest_seq, report_id)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from usagelake.functions.expressions import pair_text


def user_interest(sessions: DataFrame) -> DataFrame:
    """Sessions per user x kind (dates pooled) -> ``user_id, kind, n``."""
    return sessions.groupBy("user_id", "kind").agg(F.count("*").alias("n"))


def last_reports(facts: DataFrame) -> DataFrame:
    """The last report per user-day with its totals.

    ``max_by`` is an ordinary aggregate (partial then final), so a user-day
    with many reports is folded map-side.
    -> ``user_id, date, report_id, ingest_seq, sessions, duration_ms``.
    """
    last = F.max_by(F.struct("report_id", "ingest_seq", "sessions", "duration_ms"),
                    F.struct("ingest_seq", "report_id"))
    return (facts.groupBy("user_id", "date").agg(last.alias("last"))
            .select("user_id", "date", "last.report_id", "last.ingest_seq", "last.sessions",
                    "last.duration_ms"))


def last_documents(sessions: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """The sessions of the last report of each user-day, in session order.

    Sessions are gathered per report (one phone's document), then ``max_by``
    keeps the last document of a user-day: two aggregations, no join.
    ``facts`` adds reports without sessions; leave it out when every report
    has some.
    -> ``user_id, date, report_id, ingest_seq, apps`` (``apps`` may be empty).
    """
    app = F.struct("session_seq", "package_name", "begin_time", "end_time")
    keys = ["user_id", "date", "report_id", "ingest_seq"]
    rows = sessions.select(*keys, app.alias("app"))
    if facts is not None:
        rows = rows.unionByName(facts.select(*keys, F.lit(None).cast(rows.schema["app"].dataType).alias("app")))
    docs = rows.groupBy(*keys).agg(F.sort_array(F.collect_list("app")).alias("apps"))
    last = F.max_by(F.struct("report_id", "ingest_seq", "apps"), F.struct("ingest_seq", "report_id"))
    return docs.groupBy("user_id", "date").agg(last.alias("last")).select("user_id", "date", "last.*")


def user_day_session_count(facts: DataFrame) -> DataFrame:
    """Sessions in the last report of each user-day -> ``user_id, date, sessions``."""
    return last_reports(facts).select("user_id", "date", "sessions")


def user_day_duration_ms(facts: DataFrame) -> DataFrame:
    """Untruncated milliseconds of the last report -> ``user_id, date, duration_ms``."""
    return last_reports(facts).select("user_id", "date", "duration_ms")


def user_day_app_duration(sessions: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """Milliseconds per package in the last report -> ``user_id, date, package_name, duration_ms``.

    The packages of a user-day are on its partition already, so the sum needs
    no further exchange.
    """
    x = last_documents(sessions, facts).select("user_id", "date", F.explode("apps").alias("a"))
    return x.groupBy("user_id", "date", F.col("a.package_name").alias("package_name")).agg(
        F.sum(F.col("a.end_time") - F.col("a.begin_time")).cast("bigint").alias("duration_ms"))


def user_day_app_duration_text(sessions: DataFrame, facts: DataFrame | None = None,
                               with_seq: bool = False) -> DataFrame:
    """``pkg:ms,pkg:ms`` of the last report, packages sorted -> ``user_id, date, usage_text``."""
    last = last_documents(sessions, facts)
    extra = ["ingest_seq"] if with_seq else []
    per = last.select("user_id", "date", *extra, F.explode_outer("apps").alias("a")).groupBy(
        "user_id", "date", *extra, F.col("a.package_name").alias("p")).agg(
            F.sum(F.col("a.end_time") - F.col("a.begin_time")).cast("bigint").alias("ms"))
    pairs = F.sort_array(F.collect_list(F.when(F.col("p").isNotNull(), F.struct("p", "ms"))))
    text = F.array_join(F.transform(pairs, lambda x: pair_text(x["p"], x["ms"])), ",")
    return per.groupBy("user_id", "date", *extra).agg(text.alias("usage_text"))


def user_day_history(sessions: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """Sessions of the last report in order.

    -> ``user_id, date, session_seq, package_name, begin_time``.
    """
    x = last_documents(sessions, facts).select("user_id", "date", F.explode("apps").alias("a"))
    return x.select("user_id", "date", "a.session_seq", "a.package_name", "a.begin_time")


def user_day_history_text(sessions: DataFrame, facts: DataFrame | None = None,
                          with_seq: bool = False) -> DataFrame:
    """``pkg:begin,pkg:begin`` of the last report in session order, one text per user-day.

    A text is as long as one report document; a report without sessions gives "".
    -> ``user_id, date, history_text``.
    """
    extra = ["ingest_seq"] if with_seq else []
    text = F.array_join(F.transform("apps", lambda a: pair_text(a["package_name"], a["begin_time"])), ",")
    return last_documents(sessions, facts).select("user_id", "date", *extra, text.alias("history_text"))
