"""Queries over the cell store and the stream, on stores filled from the given tables.

Every run writes a new store under the shared folder.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from usagelake.operators import app
from usagelake.operators.app import app_daily_user_count, app_launches
from usagelake.operators.model import nest_reports
from usagelake.session import shared_dir
from usagelake.sources.fixture import table, usage_sessions
from usagelake.sources.reports import read_report_lines, reports_encode
from usagelake.streaming.cells import SKETCH, SUM, TABLE_FAMILIES, CellStore, as_deltas, merge_maps, sketch_deltas
from usagelake.streaming.pipeline import process_batch, report_deltas, start_stream
from usagelake.streaming.state import batch_status, read_sum_state, start_sum_state
from usagelake.streaming.tables import add_cell_batch, create_cell_table

ROW = "com.click.a1"


def new_store(spark: SparkSession) -> CellStore:
    store = CellStore(spark, shared_dir(spark, f"cells-{uuid.uuid4().hex}"))
    store.create_default_tables()
    return store


def launches(spark: SparkSession, sf_dir: str, slot: int) -> DataFrame:
    """Launches per package and day of the fixture's reports of one slot."""
    s = usage_sessions(spark, sf_dir, ("package_name", "date", "ingest_seq"))
    return app_launches(s.filter(F.col("ingest_seq") == slot))


def launch_deltas(spark: SparkSession, sf_dir: str, slot: int) -> DataFrame:
    return as_deltas(launches(spark, sf_dir, slot).select(
        F.lit("SINGLE_APP").alias("tbl"), F.col("package_name").alias("row_key"),
        F.lit("click_num").alias("family"), F.col("date").alias("qualifier"), F.col("n").alias("num")))


def cell_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan over a snapshot and a later batch."""
    store = new_store(spark)
    store.write_batch(launch_deltas(spark, sf_dir, 0), 0)
    store.compact(0)
    store.write_batch(launch_deltas(spark, sf_dir, 1), 1)
    return store.scan("SINGLE_APP")


def cell_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row, written by two batches and folded."""
    store = new_store(spark)
    for slot in (0, 1):
        store.write_batch(launch_deltas(spark, sf_dir, slot), slot)
    store.compact()
    return store.get("SINGLE_APP", ROW, "click_num")


def cell_put(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells overwritten in bulk after a compaction, then added to by a later batch, then folded again."""
    store = new_store(spark)
    for slot in (0, 1):
        store.write_batch(launch_deltas(spark, sf_dir, slot), slot)
    store.compact()
    cells = usage_sessions(spark, sf_dir, ("package_name", "date")).filter(
        F.col("package_name").startswith("com.click.")).select(
            F.col("package_name").alias("row_key"), F.lit("click_num").alias("family"),
            F.col("date").alias("qualifier"), F.lit("7").alias("value"))
    store.put_frame("SINGLE_APP", cells)
    store.write_batch(launch_deltas(spark, sf_dir, 0), 2)
    store.compact()
    return store.scan("SINGLE_APP")


def cell_put_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several cells of one row put after a compaction, and one put again."""
    store = new_store(spark)
    store.write_batch(launch_deltas(spark, sf_dir, 0), 0)
    store.compact()
    store.put_row("SINGLE_APP", ROW, "click_num", {"2099-01-01": 100, "2099-01-02": 200})
    store.put("SINGLE_APP", ROW, "click_num", "2099-01-02", 300)
    return store.get("SINGLE_APP", ROW)


def cell_delete_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row deleted after a compaction; a later batch shows again."""
    store = new_store(spark)
    store.write_batch(launch_deltas(spark, sf_dir, 0), 0)
    store.compact()
    store.delete_row("SINGLE_APP", ROW)
    store.write_batch(launch_deltas(spark, sf_dir, 1), 1)
    store.compact()
    store.purge(1)
    return store.scan("SINGLE_APP")


def table_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of its own, filled in bulk; creating it twice changes nothing."""
    store = new_store(spark)
    store.create_table("ORDERS", {"status": SUM})
    store.create_table("ORDERS", {"other": SUM})
    o = table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("n"))
    store.put_frame("ORDERS", o.select(
        F.col("o_custkey").cast("string").alias("row_key"), F.lit("status").alias("family"),
        F.col("o_orderstatus").alias("qualifier"), F.col("n").cast("string").alias("value")))
    return store.scan("ORDERS")


def table_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dropped table, snapshot included; created again it holds later batches only."""
    store = new_store(spark)
    store.write_batch(launch_deltas(spark, sf_dir, 0), 0)
    store.compact()
    store.drop_table("SINGLE_APP")
    store.create_table("SINGLE_APP", TABLE_FAMILIES["SINGLE_APP"])
    store.write_batch(launch_deltas(spark, sf_dir, 1), 1)
    return store.scan("SINGLE_APP")


def cell_table_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table of SUM, UNION and LAST cells read by SQL; its second batch is written twice."""
    name = f"single_app_{uuid.uuid4().hex}"
    create_cell_table(spark, name, TABLE_FAMILIES["SINGLE_APP"], shared_dir(spark, f"cell-table-{name}"), buckets=16)
    reports = nest_reports(usage_sessions(spark, sf_dir))
    for slot in (0, 1, 1):
        deltas = report_deltas(reports.filter(F.col("ingest_seq") == slot))
        add_cell_batch(spark, name, deltas.filter(F.col("tbl") == "SINGLE_APP"), slot)
    return spark.sql(f"SELECT * FROM {name}_cells")


def batch_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream over report files that arrive in three parts: every cell of every table.

    The stream is stopped and started between the parts, folds its log, and
    its last batch is run a second time.
    """
    store = new_store(spark)
    landing, checkpoint = store.root + "/landing", store.root + "/checkpoint"
    lines = report_lines(spark, sf_dir)
    half = F.pmod(F.xxhash64("report_id"), F.lit(2))
    parts = [(F.col("ingest_seq") == 0) & (half == 0), (F.col("ingest_seq") == 0) & (half == 1), F.col("ingest_seq") == 1]
    for n, part in enumerate(parts):
        lines.filter(part).select("value").write.mode("append").text(f"{landing}/part={n}")
        stream = read_report_lines(spark, f"{landing}/*", stream=True)
        start_stream(spark, stream, store, checkpoint, trigger={"availableNow": True}, compact_every=2).awaitTermination()
    last = store.last_batch()
    process_batch(store, read_report_lines(spark, f"{landing}/part=2"), last)
    scans = [store.scan(t).withColumn("tbl", F.lit(t)) for t in sorted(TABLE_FAMILIES)]
    return reduce(DataFrame.unionByName, scans)


LG_K = 12


def app_daily_user_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimated daily users from SKETCH cells of two batches, folded between and after them, beside the exact count.

    ``merged_is_one_pass``: the merged cells say what one sketch over all sessions says;
    ``within_bound``: the estimate is within five standard errors (of 1.04 / sqrt(2**LG_K)) of the exact count.
    """
    store = new_store(spark)
    store.create_table("APP_REACH", {"users": SKETCH})
    s = usage_sessions(spark, sf_dir, ("package_name", "date", "user_id", "ingest_seq"))
    for slot in (0, 1):
        users = s.filter(F.col("ingest_seq") == slot).select(
            F.lit("APP_REACH").alias("tbl"), F.col("package_name").alias("row_key"), F.lit("users").alias("family"),
            F.col("date").alias("qualifier"), F.col("user_id").alias("member"))
        store.write_batch(sketch_deltas(users, lg_k=LG_K), slot)
        store.compact()
    merged = store.scan("APP_REACH").select(
        F.col("row_key").alias("package_name"), F.col("qualifier").alias("date"), F.col("value").cast("bigint").alias("estimate"))
    keys = ["package_name", "date"]
    exact = app_daily_user_count(s).join(merged, keys).join(
        app.app_daily_user_estimate(app.app_daily_user_sketch(s, LG_K)).withColumnRenamed("users", "one_pass"), keys)
    off = F.abs(F.col("estimate") - F.col("users"))
    return exact.select(*keys, "users", (F.col("estimate") == F.col("one_pass")).alias("merged_is_one_pass"),
                        (off <= F.ceil(F.col("users") * (5 * 1.04 / 2 ** (LG_K / 2)))).alias("within_bound"))


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports_encode(nest_reports(usage_sessions(spark, sf_dir)), keep=("report_id", "ingest_seq"))


def sum_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every SUM cell from the state of a native aggregation; files arrive in three parts, the stream restarts between them."""
    root = shared_dir(spark, f"sum-state-{uuid.uuid4().hex}")
    lines = report_lines(spark, sf_dir)
    for n in range(3):
        part = F.pmod(F.xxhash64("report_id"), F.lit(3)) == n
        lines.filter(part).select("value").write.mode("append").text(f"{root}/landing/part={n}")
        start_sum_state(read_report_lines(spark, f"{root}/landing/*", stream=True), f"{root}/checkpoint",
                        {"availableNow": True}).awaitTermination()
    return read_sum_state(spark, f"{root}/checkpoint")


def stream_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted drops of a stream by batch: reports, then event properties (JSON, no reports), then part names (no JSON)."""
    root = shared_dir(spark, f"status-{uuid.uuid4().hex}")
    parts = [report_lines(spark, sf_dir).select("value"), table(spark, sf_dir, "events").select(F.col("props").alias("value")),
             table(spark, sf_dir, "part").select(F.col("p_name").alias("value"))]
    rows = []
    for n, part in enumerate(parts):
        part.write.text(f"{root}/landing/part={n}")
        query = start_sum_state(read_report_lines(spark, f"{root}/landing/*", stream=True), f"{root}/checkpoint",
                                {"availableNow": True})
        query.awaitTermination()
        rows += [(b, c["accepted"], c["nonconforming"], c["malformed"]) for b, c in batch_status(query).items() if sum(c.values())]
    return spark.createDataFrame(rows, "batch_id long, accepted long, nonconforming long, malformed long")


def q_merge_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_maps(launches(spark, sf_dir, 0), launches(spark, sf_dir, 1), ["package_name", "date"])


QUERIES = {
    "cell_put": cell_put,
    "cell_put_row": cell_put_row,
    "cell_get": cell_get,
    "cell_scan": cell_scan,
    "cell_delete_row": cell_delete_row,
    "table_create": table_create,
    "table_drop": table_drop,
    "cell_table_sql": cell_table_sql,
    "batch_sink": batch_sink,
    "merge_maps": q_merge_maps,
    "app_daily_user_estimate": app_daily_user_estimate,
    "sum_state": sum_state,
    "stream_status_counts": stream_status_counts,
}
