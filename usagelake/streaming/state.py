"""SUM cells kept in Spark's state store, instead of deltas folded on every read.

``start_sum_state`` is a native streaming aggregation in update mode: each
micro-batch is pre-aggregated, shuffled by cell and added to the cell's state,
so a batch costs its own cells and a read costs one pass over the state.
``read_sum_state`` reads the totals back from the checkpoint, of the last
committed batch or of an earlier one, without running the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from usagelake.sources.reports import STATUS_METRIC, decode_lines, status_metrics
from usagelake.streaming.cells import CELL, SUM
from usagelake.streaming.pipeline import report_cells, with_report_texts

def sum_cells(lines: DataFrame, tz: str = "UTC", bucket_unit: str = "ms") -> DataFrame:
    """Running total of every SUM cell over report lines, batch or streaming -> ``tbl, row_key, family, qualifier, value``.

    Lines that do not decode are counted in the query's progress under ``report_status``.
    """
    decoded = decode_lines(lines, "value").observe(STATUS_METRIC, *status_metrics())
    reports = decoded.filter(F.col("status") == 1).drop("value", "status")
    cells = report_cells(with_report_texts(reports), tz, bucket_unit, (SUM,))
    return cells.groupBy(*CELL).agg(F.sum("num").alias("value"))


def start_sum_state(lines: DataFrame, checkpoint: str, trigger: dict | None = None, tz: str = "UTC",
                    bucket_unit: str = "ms", sink=None):
    """Start the aggregation over a streaming DataFrame of report lines; the totals live in ``checkpoint``.

    ``sink(df, batch_id)``, if given, gets the cells that a batch changed with
    their new totals (an upsert by cell is safe on replay).
    """
    w = sum_cells(lines, tz, bucket_unit).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    w = w.foreachBatch(sink) if sink else w.format("noop")
    return (w.trigger(**trigger) if trigger else w).start()


def read_sum_state(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """Totals as of batch ``batch_id`` (the last committed one if not given) -> ``tbl, row_key, family, qualifier, value``.

    Older batches are kept as long as the session's ``spark.sql.streaming.minBatchesToRetain``.
    """
    r = spark.read.format("statestore")
    if batch_id is not None:
        r = r.option("batchId", str(batch_id))
    state = r.load(checkpoint)
    total = state.schema["value"].dataType.fieldNames()[0]
    return state.select(*[F.col(f"key.{c}").alias(c) for c in CELL], F.col(f"value.{total}").cast("bigint").alias("value"))


def batch_status(query) -> dict[int, dict]:
    """Counts of accepted, non-conforming and malformed lines by batch, from a query's recent progress."""
    out = {}
    for p in query.recentProgress:
        got = p["observedMetrics"].get(STATUS_METRIC)
        if got is not None:
            out[p["batchId"]] = got if isinstance(got, dict) else got.asDict()
    return out
