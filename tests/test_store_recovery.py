"""The cell store after a cut-short batch, with a clock set back, and after many compactions."""

import os
import time

import pytest
from pyspark.sql import functions as F

from usagelake.streaming.cells import SUM, CellStore, as_deltas


@pytest.fixture()
def store(spark, scratch):
    s = CellStore(spark, scratch + "/store")
    s.create_table("T", {"n": SUM})
    return s


def batch(store, number, n, row="r"):
    store.write_batch(as_deltas(store.spark.createDataFrame(
        [("T", row, "n", "q", n)], "tbl string, row_key string, family string, qualifier string, num long")), number)


def value(store, row="r"):
    return {r["qualifier"]: int(r["value"]) for r in store.get("T", row).collect()}


def test_a_batch_without_its_mark_is_not_read(store):
    batch(store, 0, 1)
    batch(store, 1, 2)
    batch(store, 2, 100)
    os.remove(store.mark_path + "/2")  # the write stopped before its mark
    assert value(store) == {"q": 3} and store.last_batch() == 1
    store.put("T", "r", "n", "q", 7)
    assert value(store) == {"q": 7}
    assert store.compact() == 1 and value(store) == {"q": 7}
    batch(store, 2, 100)  # the batch is run again
    assert value(store) == {"q": 107}


def test_puts_do_not_depend_on_the_clock(store, monkeypatch):
    batch(store, 0, 1)
    store.put("T", "r", "n", "q", 5)
    monkeypatch.setattr(time, "time_ns", lambda: 0)
    monkeypatch.setattr(time, "time", lambda: 0.0)
    store.put("T", "r", "n", "q", 6)
    assert value(store) == {"q": 6}
    store.compact()
    store.purge(0)
    store.put("T", "r", "n", "q", 8)  # after the cut of the snapshot
    assert value(store) == {"q": 8}
    store.delete_row("T", "r")
    assert value(store) == {}
    store.put_frame("T", store.spark.createDataFrame([("r", "n", "q", "9")], "row_key string, family string, qualifier string, value string"))
    assert value(store) == {"q": 9}


def test_old_snapshots_and_folded_puts_go(store):
    total = 0
    for n in range(4):
        batch(store, n, n + 1)
        store.put_row("T", "other", "n", {"a": n, "b": n})
        total += n + 1
        store.compact()
        store.purge(n)
        assert store._children(store.snap_path) == [f"upto={n}"] == store._children(store.cut_path)
        assert store._children(store.delta_path + "/tbl=T") == []
    assert value(store) == {"q": total} and value(store, "other") == {"a": 3, "b": 3}
    store.put("T", "other", "n", "a", 50)  # not folded: it stays
    batch(store, 4, 1)
    store.purge(3)
    assert value(store, "other") == {"a": 50, "b": 3} and value(store) == {"q": total + 1}


def test_scan_of_many_tables_after_purge(store):
    store.create_table("U", {"n": SUM})
    batch(store, 0, 1)
    store.put("U", "x", "n", "q", 1)
    store.compact()
    store.put("U", "x", "n", "q", 2)
    store.purge(0)
    assert [r["value"] for r in store.scan("U").collect()] == ["2"] and value(store) == {"q": 1}
    assert store.deltas().filter(F.col("batch_id") == -1).count() == 2



def test_reads_without_administrative_rows_need_no_join(store):
    batch(store, 0, 1)
    store.compact()
    batch(store, 1, 2)
    for df in (store.get("T", "r", "n"), store.scan("T")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and plan.count("BroadcastExchange") == 1  # the declared families
        assert plan.count("Exchange hashpartitioning") == 1
    store.put("T", "r", "n", "q", 9)
    assert value(store) == {"q": 9}
    store.compact()
    assert value(store) == {"q": 9}


def _rows_read(df):
    """Rows that the scans of an executed query gave."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().get("numOutputRows").get().value() for i in range(leaves.size())
               if "Scan parquet" in leaves.apply(i).nodeName())


def test_a_row_is_found_without_reading_other_files(spark, store):
    """Row keys of every file span the same range, so only the bloom filter can rule a file out."""
    keep = spark.conf.get("spark.sql.adaptive.enabled")
    for n in range(3):
        rows = spark.range(2000).select(
            F.lit("T").alias("tbl"), F.format_string(f"%05d-{n}", F.col("id")).alias("row_key"), F.lit("n").alias("family"),
            F.lit("q").alias("qualifier"), F.lit(1).alias("num"))
        store.write_batch(as_deltas(rows), n)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert value(store, "00700-1") == {"q": 1}
        assert _rows_read(store.get("T", "00700-1", "n")) == 2000  # one file of three
        assert _rows_read(store.get("T", "00700-7", "n")) == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", keep)
