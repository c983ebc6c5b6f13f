"""Reports stream -> metric deltas -> cell tables.

``report_deltas`` turns one batch of nested reports into delta rows for
every cell table with two aggregations: every report emits one array with
all its SUM / UNION / version cells (report grain, eight per session, two per
package), which one explode and one ``groupBy`` fold; the per-user-day LAST
values come from one ``max_by``.  ``metric_deltas`` computes the same deltas
from long session rows (one aggregation per grain) for data that is not
nested.

``start_stream`` wires it into Structured Streaming with ``foreachBatch``:
each batch is decoded and staged as Parquet once, all metrics are derived
from the staged copy, one write replaces the batch's partitions (idempotent
on replay), and lines that did not decode go to a quarantine folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from usagelake.functions.expressions import (
    bucket_sql, duration_bucket, hour_of, hour_sql, pair_text_sql, trunc_seconds,
    trunc_seconds_sql, week_of_month, week_of_month_sql,
)
from usagelake.operators import app, user
from usagelake.operators.model import Usage
from usagelake.sources.reports import STATUS_METRIC, arrival, decode_lines, status_metrics
from usagelake.streaming.cells import CELL, LAST, SUM, UNION, CellStore, as_deltas

# The AIV family each device column is written to.
AIV_FAMILIES = (("brand", "brand"), ("model", "model"), ("system_version", "system_version"),
                ("resolution", "resolution"), ("net_status", "net_status"), ("isp", "ISP"))


def _cell(tbl: str, row: Column, family: str, qualifier: Column, num: Column | int = 1) -> Column:
    n = num if isinstance(num, Column) else F.lit(num)
    return F.struct(F.lit(tbl).alias("tbl"), row.cast("string").alias("row_key"),
                    F.lit(family).alias("family"), qualifier.cast("string").alias("qualifier"),
                    n.cast("bigint").alias("num"))


def _fold(df: DataFrame, cells: list[Column]) -> DataFrame:
    x = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    return x.groupBy(*CELL).agg(F.sum("num").cast("bigint").alias("num"))


def session_sum_deltas(sessions: DataFrame, tz: str = "UTC") -> DataFrame:
    """All session-grain SUM cells in one aggregation."""
    pkg, date = F.col("package_name"), F.col("date")
    hour = hour_of("begin_time", tz)
    return _fold(sessions, [
        _cell("SINGLE_APP", pkg, "click_num", date),
        _cell("APP_VERSION", F.concat_ws("_", pkg, F.col("version")), "click_num", date),
        _cell("SINGLE_APP", pkg, "duration", date, trunc_seconds()),
        _cell("SINGLE_APP", pkg, "day_period", hour),
        _cell("SINGLE_APP", pkg, "week_period", week_of_month("begin_time", tz)),
        _cell("USER", F.col("user_id"), "hobby", F.col("kind")),
        _cell("USER_GROUP", date, "hobby", F.col("kind")),
        _cell("USER_GROUP", date, "period", hour),
    ])


def report_sum_deltas(facts: DataFrame, bucket_unit: str = "ms") -> DataFrame:
    """All report-grain SUM cells in one aggregation (reports without sessions count)."""
    date = F.col("date")
    cells = [_cell("AIV", date, fam, F.col(c)) for c, fam in AIV_FAMILIES]
    cells += [_cell("USER_GROUP", date, "location", F.col("province")),
              _cell("USER_GROUP", date, "usage", duration_bucket("duration_ms", bucket_unit))]
    return _fold(facts, cells)


def app_usage_deltas(sessions: DataFrame) -> DataFrame:
    """APP_USAGE[package].<bucket>[date]: reports whose seconds in the package fall in the bucket."""
    per = app.report_app_seconds(sessions)
    b = per.select(F.lit("APP_USAGE").alias("tbl"), F.col("package_name").alias("row_key"),
                   duration_bucket("seconds", "s").alias("family"), F.col("date").alias("qualifier"))
    return b.groupBy(*CELL).agg(F.count("*").alias("num"))


def union_deltas(sessions: DataFrame) -> DataFrame:
    """SINGLE_APP[package].user[date] members."""
    u = app.app_daily_users(sessions)
    return u.select(F.lit("SINGLE_APP").alias("tbl"), F.col("package_name").alias("row_key"),
                    F.lit("user").alias("family"), F.col("date").alias("qualifier"),
                    F.col("user_id").alias("text"))


def last_deltas(usage: Usage) -> DataFrame:
    """LAST cells: version index and the per-user-day values of the last report."""
    s, f = usage.sessions, usage.facts
    ver = app.app_version_index(s).select(
        F.lit("SINGLE_APP").alias("tbl"), F.col("package_name").alias("row_key"),
        F.lit("version").alias("family"), F.col("version").alias("qualifier"),
        F.col("version").alias("text"))
    last = user.last_reports(f)

    def user_cell(df: DataFrame, family: str, value: Column) -> DataFrame:
        return df.select(F.lit("USER").alias("tbl"), F.col("user_id").alias("row_key"),
                         F.lit(family).alias("family"), F.col("date").alias("qualifier"),
                         value.cast("string").alias("text"))

    parts = [
        ver,
        user_cell(last, "usage_duration", F.col("duration_ms")),
        user_cell(last, "usage_times", F.col("sessions")),
        user_cell(user.user_day_app_duration_text(s, f, with_seq=True), "usage_statistics",
                  F.col("usage_text")),
        user_cell(user.user_day_history_text(s, f, with_seq=True),
                  "usage_history", F.col("history_text")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def metric_deltas(usage: Usage, tz: str = "UTC", bucket_unit: str = "ms",
                  laws=(SUM, UNION, LAST)) -> DataFrame:
    """Every metric of one batch as delta rows (epoch/seq filled by the writer).

    ``laws`` limits the output to families of those merge laws.
    """
    s, f = usage.sessions, usage.facts
    parts = []
    if SUM in laws:
        parts += [as_deltas(session_sum_deltas(s, tz)),
                  as_deltas(report_sum_deltas(f, bucket_unit)),
                  as_deltas(app_usage_deltas(s))]
    if UNION in laws:
        parts.append(as_deltas(union_deltas(s)))
    if LAST in laws:
        parts.append(as_deltas(last_deltas(usage)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- fused path for nested reports -------------------------------------
# Built as SQL text: each array of cells is one expression parsed once by
# the JVM, instead of thousands of Column-building round trips per batch.

def _cell_sql(tbl: str, row: str, family: str, qualifier: str, num: str = "1",
              text: str = "NULL") -> str:
    fam = family if family.startswith(("CASE", "(")) else f"'{family}'"
    return (f"named_struct('tbl', '{tbl}', 'row_key', CAST({row} AS STRING), 'family', {fam}, "
            f"'qualifier', CAST({qualifier} AS STRING), 'num', CAST({num} AS BIGINT), "
            f"'text', CAST({text} AS STRING))")


def _session_cells_sql(tz: str) -> str:
    """``flatten(transform(apps, a -> array(<8 SUM cells of session a>)))``."""
    hour = hour_sql("a.begin_time", tz)
    week = week_of_month_sql("a.begin_time", tz)
    secs = trunc_seconds_sql("a.begin_time", "a.end_time")
    cells = [
        _cell_sql("SINGLE_APP", "a.package_name", "click_num", "date"),
        _cell_sql("APP_VERSION", "concat_ws('_', a.package_name, a.version)", "click_num", "date"),
        _cell_sql("SINGLE_APP", "a.package_name", "duration", "date", secs),
        _cell_sql("SINGLE_APP", "a.package_name", "day_period", hour),
        _cell_sql("SINGLE_APP", "a.package_name", "week_period", week),
        _cell_sql("USER", "user_id", "hobby", "a.kind"),
        _cell_sql("USER_GROUP", "date", "hobby", "a.kind"),
        _cell_sql("USER_GROUP", "date", "period", hour),
    ]
    return f"flatten(transform(apps, a -> array({', '.join(cells)})))"


def _report_cells_sql(bucket_unit: str) -> str:
    cells = [_cell_sql("AIV", "date", fam, c) for c, fam in AIV_FAMILIES]
    cells += [_cell_sql("USER_GROUP", "date", "location", "province"),
              _cell_sql("USER_GROUP", "date", "usage", bucket_sql("duration_ms", bucket_unit))]
    return f"array({', '.join(cells)})"


def with_report_texts(reports: DataFrame) -> DataFrame:
    """Per-report values computed inside the ``apps`` array (no shuffle).

    Adds ``pkg_totals`` (distinct packages with truncated seconds and
    untruncated ms, sorted by package), ``usage_text``, ``history_text``,
    ``sessions`` and ``duration_ms``.  A report is one document, so this
    work is bounded by its size.
    """
    # Sessions sorted by package, the positions where a package starts, and
    # one sum per stretch: linear in the sessions (after the sort), however
    # many packages a report has.  Each step is a column of its own, so the
    # next one reads it instead of computing it again.
    r = reports.selectExpr(
        "*", "array_sort(transform(apps, a -> named_struct('p', a.package_name, 's', "
             f"{trunc_seconds_sql('a.begin_time', 'a.end_time')}, 'm', a.end_time - a.begin_time))) AS _sorted")
    r = r.selectExpr("*", "filter(transform(_sorted, (x, i) -> "
                          "if(i > 0 AND _sorted[i - 1].p <=> x.p, -1, i)), i -> i >= 0) AS _starts")
    stretch = "slice(_sorted, st + 1, coalesce(get(_starts, j + 1), size(_sorted)) - st)"
    totals = (f"transform(_starts, (st, j) -> named_struct('package_name', _sorted[st].p, "
              f"'secs', aggregate({stretch}, 0L, (acc, x) -> acc + x.s), "
              f"'ms', aggregate({stretch}, 0L, (acc, x) -> acc + x.m)))")
    r = r.withColumn("pkg_totals", F.expr(totals)).drop("_sorted", "_starts")
    return r.selectExpr(
        "*",
        f"array_join(transform(pkg_totals, x -> {pair_text_sql('x.package_name', 'x.ms')}), ',') AS usage_text",
        f"array_join(transform(apps, a -> {pair_text_sql('a.package_name', 'a.begin_time')}), ',') AS history_text",
        "CAST(size(apps) AS BIGINT) AS sessions",
        "aggregate(apps, 0L, (acc, a) -> acc + (a.end_time - a.begin_time)) AS duration_ms")


def report_cells(r: DataFrame, tz: str, bucket_unit: str, laws, by=()) -> DataFrame:
    """Cells of reports with their per-report values (``with_report_texts``), one row each, not yet folded.

    A report emits its report-grain SUM cells, eight SUM cells per session, an
    APP_USAGE bucket cell and a UNION member cell per package, and a version
    cell per (package, version).
    """
    cells = []
    if SUM in laws:
        cells.append(_report_cells_sql(bucket_unit))
        cells.append(_session_cells_sql(tz))
        cells.append("transform(pkg_totals, x -> " + _cell_sql(
            "APP_USAGE", "x.package_name", bucket_sql("x.secs", "s"), "date") + ")")
    if UNION in laws:
        cells.append("transform(pkg_totals, x -> " + _cell_sql(
            "SINGLE_APP", "x.package_name", "user", "date", "NULL", "user_id") + ")")
    if LAST in laws:
        cells.append("transform(array_distinct(transform(apps, a -> named_struct("
                     "'p', a.package_name, 'v', a.version))), x -> "
                     + _cell_sql("SINGLE_APP", "x.p", "version", "x.v", "NULL", "x.v") + ")")
    return r.selectExpr(*by, f"explode(concat({', '.join(cells)})) AS c").select(*by, "c.*")


def report_deltas(reports: DataFrame, tz: str = "UTC", bucket_unit: str = "ms",
                  laws=(SUM, UNION, LAST), batch: Column | None = None) -> DataFrame:
    """All metric deltas of a batch of nested reports in two aggregations.

    1. Every report emits one array of cells (``report_cells``); one explode
       and one ``groupBy(cell, text)`` fold them all.
    2. The per-user-day LAST values come from one ``max_by`` aggregation
       over report-grain structs.

    ``batch`` (a column of batch numbers) folds several batches at once, each
    by itself, and sets their epochs.
    """
    r = with_report_texts(reports if batch is None else reports.withColumn("_batch", batch))
    by = [] if batch is None else ["_batch"]
    epoch = F.lit(0) if batch is None else F.col("_batch") * 2
    x = report_cells(r, tz, bucket_unit, laws, by)
    folded = x.groupBy(*by, *CELL, "text").agg(F.sum("num").cast("bigint").alias("num"))
    parts = [as_deltas(folded, epoch=epoch)]
    if LAST in laws:
        # The batch's winner is chosen here, in arrival order; between batches the epoch decides.
        last = r.groupBy(*by, "user_id", "date").agg(F.expr(
            "max_by(named_struct('ms', duration_ms, 'n', sessions, "
            "'usage', usage_text, 'history', history_text), "
            "named_struct('s', ingest_seq, 'r', report_id))").alias("l"))
        u = last.selectExpr(
            *by, "'USER' AS tbl", "user_id AS row_key", "date AS qualifier",
            "inline(array("
            "named_struct('family', 'usage_duration', 'text', CAST(l.ms AS STRING)), "
            "named_struct('family', 'usage_times', 'text', CAST(l.n AS STRING)), "
            "named_struct('family', 'usage_statistics', 'text', l.usage), "
            "named_struct('family', 'usage_history', 'text', l.history)))")
        parts.append(as_deltas(u, epoch=epoch))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- the streaming job --------------------------------------------------

def kafka_ingest_seq() -> Column:
    """Arrival order of Kafka records: broker timestamp, then partition and offset (a struct)."""
    return F.struct(F.unix_millis(F.col("timestamp")).alias("ms"), F.col("partition").cast("int").alias("partition"),
                    F.col("offset").cast("bigint").alias("offset"))


def process_batch(store: CellStore, lines: DataFrame, batch_id: int, tz: str = "UTC",
                  bucket_unit: str = "ms", quarantine: str | None = None,
                  value_col: str = "value", ingest_seq: Column | None = None) -> dict[str, int]:
    """Decode one batch of lines and write its deltas as batch ``batch_id``; returns its lines by status.

    The decoded batch is first written to ``<store>/staging/batch_id=<n>``
    (a retried batch replaces it) and read back by that path.  That cuts the
    lineage: a lost executor re-reads staged Parquet instead of the source, the
    arrival order is fixed once, and every metric plans against a plain scan.
    Lines that did not decode keep their text there and are copied to
    ``quarantine``.  The staged files go when the batch is written.
    """
    order = ingest_seq if ingest_seq is not None else arrival(lines)
    decoded = decode_lines(lines.withColumn("ingest_seq", order), value_col).drop("arrival", "source_file")
    staged = decoded.withColumn(
        "report_id", F.concat_ws(":", F.lit(str(batch_id)), F.col("ingest_seq").cast("string"))
    ).withColumn(value_col, F.when(F.col("status") < 1, F.col(value_col)))
    staging = f"{store.root}/staging/batch_id={batch_id}"
    status = Observation(STATUS_METRIC)  # counted by the pass that writes the batch
    staged.observe(status, *status_metrics()).write.mode("overwrite").parquet(staging)
    back = store.spark.read.schema(staged.schema).parquet(staging)
    reports = back.filter(F.col("status") == 1).drop(value_col, "status")
    store.write_batch(store.declared(report_deltas(reports, tz, bucket_unit)), batch_id)
    if quarantine:
        bad = back.filter(F.col("status") < 1).select("status", value_col)
        (bad.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(quarantine))
    store.discard(staging)
    return status.get


def start_stream(spark: SparkSession, lines: DataFrame, store: CellStore, checkpoint: str,
                 trigger: dict | None = None, tz: str = "UTC", bucket_unit: str = "ms",
                 quarantine: str | None = None, query_name: str | None = None,
                 compact_every: int | None = None, ingest_seq: Column | None = None,
                 on_status: Callable[[int, dict[str, int]], None] | None = None):
    """Start the metrics stream over a streaming DataFrame of text lines.

    ``trigger`` is passed to ``DataStreamWriter.trigger`` (for example
    ``{"processingTime": "50 seconds"}`` or ``{"availableNow": True}``).
    ``compact_every=k`` folds the log into a snapshot after every k-th batch.
    ``ingest_seq`` orders reports within a batch (``kafka_ingest_seq()`` for
    a Kafka source); the default is arrival order (file time, path, place).
    ``on_status(batch_id, counts)`` gets the lines ``accepted``, ``nonconforming`` and
    ``malformed`` of every batch (again for a batch that is run again).
    The checkpoint and the store must live and die together: batch ids
    restart at 0 without a checkpoint and would overwrite old batches, and a
    checkpoint without its store would leave earlier batches out.  Both are
    refused.
    """
    committed = store.committed(checkpoint)
    if store.last_batch() >= 0 and not store._exists(checkpoint + "/offsets"):
        raise RuntimeError("store has batches but the checkpoint is missing; refusing to start")
    if committed > store.last_batch():
        raise RuntimeError(f"the checkpoint has committed batch {committed}, the store ends at batch "
                           f"{store.last_batch()}; refusing to start")
    store.create_default_tables()

    def run(df: DataFrame, batch_id: int) -> None:
        counts = process_batch(store, df, batch_id, tz, bucket_unit, quarantine, ingest_seq=ingest_seq)
        if on_status:
            on_status(batch_id, counts)
        # Fold the log every `compact_every` batches so reads stay bounded by
        # the state size, not by the number of batches, and remove what was
        # folded.  A replayed batch rewrites its partition, which readers skip
        # behind the snapshot, and finds the compaction done.
        if compact_every and (batch_id + 1) % compact_every == 0:
            store.compact(batch_id)
            store.purge(batch_id)

    w = lines.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
