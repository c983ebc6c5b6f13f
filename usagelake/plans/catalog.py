"""Named queries over a scale-factor folder: ``name -> fn(spark, sf_dir)``.

Every query reads the given tables (through the usage fixture or directly),
so its work grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from usagelake.functions.random import uniform_int
from usagelake.operators import alias, app, device, population, sampling, user
from usagelake.operators.model import Usage, explode_sessions, facts_from_sessions, nest_reports
from usagelake.plans.store_queries import QUERIES as STORE_QUERIES
from usagelake.sources.fixture import table, usage_sessions
from usagelake.streaming import cells
from usagelake.streaming.pipeline import report_deltas
from usagelake.sources.reports import decode_status_counts, reports_decode, reports_encode

Query = Callable[[SparkSession, str], DataFrame]


_S = ("report_id", "user_id", "date", "session_seq", "package_name", "begin_time", "end_time",
      "version", "kind", "ingest_seq")


def _s(fn) -> Query:
    """A query over the session grain that reads no column of the user dimension."""
    return lambda spark, d: fn(usage_sessions(spark, d, _S))


def _f(fn, *columns: str) -> Query:
    """A query over the report grain with ``columns`` beside the report's keys."""
    def q(spark, d):
        wanted = ("report_id", "date", "begin_time", "end_time") + columns
        return fn(facts_from_sessions(usage_sessions(spark, d, wanted)))
    return q


def _device(dim: str) -> Query:
    return _f(lambda facts: device.device_counts(facts, dim), dim)


def sessions_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nest the fixture into report documents, then explode them again."""
    reports = nest_reports(usage_sessions(spark, sf_dir, _S))
    return explode_sessions(reports).select(
        "report_id", "user_id", "date", "session_seq", "package_name", "begin_time",
        "end_time", "version", "kind")


def fixture_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture as report JSON lines -> ``report_id, ingest_seq, value``."""
    reports = nest_reports(usage_sessions(spark, sf_dir))
    return reports_encode(reports, keep=("report_id", "ingest_seq"))


def q_reports_encode(spark, d):
    return reports_encode(nest_reports(usage_sessions(spark, d)))


def q_reports_decode(spark, d):
    """Encode the fixture, decode it strictly, report grain of what came back."""
    lines = fixture_lines(spark, d)
    reports = reports_decode(lines, report_id=F.col("report_id"), ingest_seq=F.col("ingest_seq"))
    facts = Usage.from_reports(reports).facts
    return facts.drop("ingest_seq")


def q_decode_status(spark, d):
    """Status counts over fixture reports, ``events.props`` texts (JSON, no reports) and
    ``part.p_name`` texts (no JSON)."""
    lines = (fixture_lines(spark, d).select("value")
             .unionByName(table(spark, d, "events").select(F.col("props").alias("value")))
             .unionByName(table(spark, d, "part").select(F.col("p_name").alias("value"))))
    return decode_status_counts(lines)


def two_batch_deltas(spark: SparkSession, sf_dir: str, law: str) -> DataFrame:
    """Deltas of the fixture as two stream batches.

    Batch 0 holds the slot-0 reports and batch 1 the slot-1 reports, so a
    user-day with two reports is overwritten across batches.  The documents
    are nested once, with the columns the law needs, and folded per batch by
    the stream's own code.
    """
    columns = _S if law != cells.SUM else None
    reports = nest_reports(usage_sessions(spark, sf_dir, columns))
    return report_deltas(reports, laws=(law,), batch=F.col("ingest_seq"))


def q_merge_sum(spark, d):
    return cells.merge_sum(two_batch_deltas(spark, d, cells.SUM), admin=False)


def q_merge_union(spark, d):
    return cells.merge_union(two_batch_deltas(spark, d, cells.UNION), admin=False)


def q_merge_last(spark, d):
    return cells.merge_last(two_batch_deltas(spark, d, cells.LAST), admin=False)


def wifi_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = facts_from_sessions(usage_sessions(spark, sf_dir, ("report_id", "net_status", "begin_time", "end_time")))
    return population.conditional_share(facts, F.col("net_status") == "wifi")


# ---- weighted draws over dimension tables --------------------------------

def part_brand_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand/model weight table: parts per (brand, type)."""
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("brand"), F.col("p_type").alias("model"), F.lit(1).alias("weight"))


def _order_draws(spark: SparkSession, sf_dir: str, total: int) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return o.withColumn("r", sampling.draw_position("o_orderkey", total))


def q_weight_rollup(spark, d):
    return sampling.weight_rollup(part_brand_model(spark, d), "brand")


def q_weight_cumulative(spark, d):
    return sampling.weight_cumulative(part_brand_model(spark, d), ["brand", "model"])


def q_weighted_draw(spark, d):
    apps = usage_sessions(spark, d, ("package_name", "kind")).select("*", F.lit(1).alias("weight"))
    cum = sampling.weight_cumulative(apps, ["package_name", "kind"])
    total = sampling.total_weight(cum)
    return sampling.weighted_draw(_order_draws(spark, d, total), cum, "r",
                                  ["package_name", "kind"])


def q_hierarchical_draw(spark, d):
    w = part_brand_model(spark, d)
    total = sampling.total_weight(sampling.weight_rollup(w, "brand"))
    return sampling.hierarchical_draw(_order_draws(spark, d, total), w, "brand", "model",
                                      parent_draw="r", child_draw_key="o_orderkey")


def q_uniform_draw(spark, d):
    users = table(spark, d, "customer").select("c_custkey", F.lit(1).alias("weight"))
    cum = sampling.weight_cumulative(users, "c_custkey")
    total = sampling.total_weight(cum)
    return sampling.weighted_draw(_order_draws(spark, d, total), cum, "r", "c_custkey")


SEED = 20


def q_random_int(spark, d):
    """A uniform customer index for every order."""
    n = table(spark, d, "customer").count()
    return table(spark, d, "orders").select("o_orderkey", uniform_int(n, "o_orderkey", SEED, "customer").alias("r"))


def q_alias_table(spark, d):
    t = alias.alias_table(part_brand_model(spark, d), ["brand", "model"])
    return t.select("slot", "brand", "model", "weight", "own", F.col("alias.brand").alias("alias_brand"),
                    F.col("alias.model").alias("alias_model"), "n", "total")


def q_alias_table_by_brand(spark, d):
    t = alias.alias_table(part_brand_model(spark, d), "model", "brand")
    return t.select("brand", "slot", "model", "weight", "own", F.col("alias.model").alias("alias_model"), "n", "total")


def q_alias_draw(spark, d):
    apps = usage_sessions(spark, d, ("package_name", "kind")).select("*", F.lit(1).alias("weight"))
    t = alias.alias_table(apps, ["package_name", "kind"])
    return alias.alias_draw(table(spark, d, "orders").select("o_orderkey"), t, "o_orderkey", ["package_name", "kind"], SEED)


def q_alias_hierarchical_draw(spark, d):
    return alias.alias_hierarchical_draw(table(spark, d, "orders").select("o_orderkey"), part_brand_model(spark, d),
                                         "brand", "model", "o_orderkey", SEED)


QUERIES: dict[str, Query] = {
    "aiv_brand": _device("brand"),
    "aiv_model": _device("model"),
    "aiv_system_version": _device("system_version"),
    "aiv_resolution": _device("resolution"),
    "aiv_net_status": _device("net_status"),
    "aiv_isp": _device("isp"),
    "aiv_all": _f(device.device_counts_all, *device.DEVICE_DIMENSIONS),
    "app_launches": _s(app.app_launches),
    "app_daily_users": _s(app.app_daily_users),
    "app_daily_user_count": _s(app.app_daily_user_count),
    "app_daily_users_text": _s(app.app_daily_users_text),
    "app_version_index": _s(app.app_version_index),
    "app_version_launches": _s(app.app_version_launches),
    "app_duration_seconds": _s(app.app_duration_seconds),
    "app_usage_buckets": _s(app.app_usage_buckets),
    "app_hour_profile": _s(app.app_hour_profile),
    "app_week_profile": _s(app.app_week_profile),
    "user_interest": _s(user.user_interest),
    "user_day_duration_ms": _f(user.user_day_duration_ms, "user_id", "ingest_seq"),
    "user_day_session_count": _f(user.user_day_session_count, "user_id", "ingest_seq"),
    "user_day_app_duration": _s(user.user_day_app_duration),
    "user_day_app_duration_text": _s(user.user_day_app_duration_text),
    "user_day_history": _s(user.user_day_history),
    "user_day_history_text": _s(user.user_day_history_text),
    "group_interest": _s(population.group_interest),
    "group_province": _f(population.group_province, "province"),
    "group_usage_bucket": _f(population.group_usage_bucket),
    "group_hour_profile": _s(population.group_hour_profile),
    "conditional_share": wifi_share,
    "sessions_explode": sessions_explode,
    "reports_encode": q_reports_encode,
    "reports_decode": q_reports_decode,
    "decode_status_counts": q_decode_status,
    "merge_sum": q_merge_sum,
    "merge_union": q_merge_union,
    "merge_last": q_merge_last,
    "weight_rollup": q_weight_rollup,
    "weight_cumulative": q_weight_cumulative,
    "weighted_draw": q_weighted_draw,
    "hierarchical_draw": q_hierarchical_draw,
    "uniform_draw": q_uniform_draw,
    "random_int": q_random_int,
    "alias_table": q_alias_table,
    "alias_table_by_brand": q_alias_table_by_brand,
    "alias_draw": q_alias_draw,
    "alias_hierarchical_draw": q_alias_hierarchical_draw,
    **STORE_QUERIES,
}
