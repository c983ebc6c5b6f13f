"""SUM cells in the state store: restarts, earlier batches, counted drops."""

import os

import pytest
from pyspark.sql import functions as F

from usagelake.operators.model import nest_reports
from usagelake.sources.fixture import usage_sessions
from usagelake.sources.reports import decode_status_counts, read_report_lines, reports_encode
from usagelake.streaming import cells
from usagelake.streaming.cells import CellStore
from usagelake.streaming.pipeline import report_deltas, start_stream
from usagelake.streaming.state import batch_status, read_sum_state, start_sum_state, sum_cells

from conftest import SF_SMALL

BAD = ["{broken", "", "[]", '{"user_id": "1"}', "7", "null"]


def totals(df):
    return {tuple(r[c] for c in cells.CELL): r["value"] for r in df.collect()}


@pytest.fixture()
def parts(spark, scratch):
    """Report lines in three folders, the second with lines that do not decode."""
    lines = reports_encode(nest_reports(usage_sessions(spark, SF_SMALL))).select("value")

    def write(n):
        part = lines.filter(F.pmod(F.xxhash64("value"), F.lit(3)) == n)
        if n == 1:
            part = part.union(spark.createDataFrame([(x,) for x in BAD], "value string"))
        part.coalesce(2).write.text(os.path.join(scratch, "in", f"part={n}"))
    return write


def run(spark, scratch, **args):
    stream = read_report_lines(spark, os.path.join(scratch, "in", "*"), stream=True)
    q = start_sum_state(stream, os.path.join(scratch, "ckpt"), {"availableNow": True}, **args)
    q.awaitTermination(300)
    return q


def test_restarts_and_earlier_batches(spark, scratch, parts):
    seen = []
    for n in range(3):
        parts(n)
        run(spark, scratch)
        now = totals(sum_cells(read_report_lines(spark, os.path.join(scratch, "in", "*"))))
        assert totals(read_sum_state(spark, os.path.join(scratch, "ckpt"))) == now
        seen.append(now)
    run(spark, scratch)  # nothing new
    assert totals(read_sum_state(spark, os.path.join(scratch, "ckpt"))) == seen[2]
    assert totals(read_sum_state(spark, os.path.join(scratch, "ckpt"), 1)) == seen[1] != seen[2]
    reports = nest_reports(usage_sessions(spark, SF_SMALL))
    assert seen[2] == totals(cells.merge_sum(report_deltas(reports, laws=(cells.SUM,)), admin=False))


def test_counted_drops_and_changed_cells(spark, scratch, parts):
    got = []
    for n in range(2):
        parts(n)
        q = run(spark, scratch, sink=lambda df, b: got.append((b, totals(df))))
        counts = batch_status(q)[n]
        want = {r["status"]: r["lines"] for r in decode_status_counts(
            read_report_lines(spark, os.path.join(scratch, "in", f"part={n}"))).collect()}
        assert (counts["accepted"], counts["nonconforming"], counts["malformed"]) == tuple(want.get(s, 0) for s in (1, 0, -1))
    assert counts["nonconforming"] == 4 and counts["malformed"] == 2
    merged = {}
    for _, changed in got:
        merged.update(changed)  # an upsert by cell
    assert merged == totals(read_sum_state(spark, os.path.join(scratch, "ckpt")))


def test_stream_reports_status_by_batch(spark, scratch, parts):
    parts(0)
    parts(1)
    store, counts = CellStore(spark, os.path.join(scratch, "store")), {}
    stream = read_report_lines(spark, os.path.join(scratch, "in", "*"), stream=True, max_files_per_trigger=2)
    start_stream(spark, stream, store, os.path.join(scratch, "ckpt"), trigger={"availableNow": True},
                 on_status=counts.__setitem__).awaitTermination(300)
    want = {r["status"]: r["lines"] for r in decode_status_counts(
        read_report_lines(spark, os.path.join(scratch, "in", "*"))).collect()}
    assert sorted(counts) == list(range(len(counts))) and len(counts) == 2
    assert [sum(c[k] for c in counts.values()) for k in ("accepted", "nonconforming", "malformed")] == [want[1], want[0], want[-1]]
