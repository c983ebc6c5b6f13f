"""Cell tables in the catalog: SQL gives what the store gives, folds need no exchange."""

import re

import pytest
from pyspark.sql import functions as F

from usagelake.plans import oracle, store_queries
from usagelake.streaming.cells import LAST, SKETCH, SUM, UNION, CellStore, DELTA_SCHEMA
from usagelake.streaming.tables import add_cell_batch, create_cell_table, drop_cell_table

from conftest import SF_SMALL

FAMILIES = {"n": SUM, "who": UNION, "state": LAST}


def deltas(spark, rows):
    """Rows of (row_key, family, qualifier, num, text, seq)."""
    return spark.createDataFrame([("T", r, f, q, "add", n, x, 0, s) for r, f, q, n, x, s in rows], DELTA_SCHEMA)


BATCHES = [
    [("r", "n", "a", 2, None, 0), ("r", "n", "a", 3, None, 0), ("r", "who", "a", None, "u1", 0), ("r", "who", "a", None, "u1", 0),
     ("r", "who", "a", None, "", 0), ("r", "state", "a", None, "old", 1), ("r", "state", "a", None, "new", 2), (None, "n", None, 1, None, 0)],
    [("r", "n", "a", 10, None, 0), ("s", "n", "a", None, None, 0), ("r", "who", "a", None, "u2", 0), ("r", "state", "a", None, "newest", 0),
     ("r", "who", "b", None, None, 0)],
    [],
]


def cells(df):
    return sorted(map(tuple, df.select("row_key", "family", "qualifier", "law", "value").collect()), key=repr)


def test_sql_equals_store_scan(spark, scratch):
    store = CellStore(spark, scratch + "/store")
    store.create_table("T", FAMILIES)
    assert create_cell_table(spark, "t_scan", FAMILIES, scratch + "/t_scan", buckets=4)
    assert not create_cell_table(spark, "t_scan", FAMILIES)
    for n, rows in enumerate(BATCHES):
        store.write_batch(deltas(spark, rows), n)
        add_cell_batch(spark, "t_scan", deltas(spark, rows), n)
    want = cells(store.scan("T"))
    assert ("r", "n", "a", "SUM", "15") in want and ("r", "state", "a", "LAST", "newest") in want
    assert cells(spark.sql("SELECT * FROM t_scan_cells")) == want
    add_cell_batch(spark, "t_scan", deltas(spark, BATCHES[1]), 1)  # a batch written again
    assert cells(spark.sql("SELECT * FROM t_scan_cells")) == want
    got = spark.sql("SELECT value FROM t_scan_cells WHERE row_key = 'r' AND family = 'n'").collect()
    assert [r.value for r in got] == ["15"]
    assert drop_cell_table(spark, "t_scan") and not drop_cell_table(spark, "t_scan")
    # the rows are still at the location: a table created there finds them
    create_cell_table(spark, "t_scan", FAMILIES, scratch + "/t_scan", buckets=4)
    assert cells(spark.table("t_scan_cells")) == want
    drop_cell_table(spark, "t_scan")


def test_fold_has_no_exchange(spark, scratch):
    create_cell_table(spark, "t_plan", FAMILIES, scratch + "/t_plan", buckets=4)
    for n, rows in enumerate(BATCHES):
        add_cell_batch(spark, "t_plan", deltas(spark, rows), n)
    plan = spark.table("t_plan_cells")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and re.search(r"Bucketed: true", plan)
    drop_cell_table(spark, "t_plan")


def test_members_of_one_cell_lie_in_all_buckets(spark, scratch):
    create_cell_table(spark, "t_hot", FAMILIES, scratch + "/t_hot", buckets=4)
    rows = spark.range(4000).select(
        F.lit("T").alias("tbl"), F.lit("hot").alias("row_key"), F.lit("who").alias("family"), F.lit("d").alias("qualifier"),
        F.col("id").cast("string").alias("text"))
    add_cell_batch(spark, "t_hot", rows, 0)
    sizes = [r["n"] for r in spark.table("t_hot").groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 4 and sum(sizes) == 4000 and max(sizes) < 1200
    drop_cell_table(spark, "t_hot")


def test_refusals(spark, scratch):
    with pytest.raises(ValueError):
        create_cell_table(spark, "t_bad", {"f": SKETCH})
    with pytest.raises(ValueError):
        create_cell_table(spark, "t_bad", {"f'": SUM})
    create_cell_table(spark, "t_bad", {"n": SUM}, scratch + "/t_bad", buckets=2)
    with pytest.raises(Exception, match="declared family"):
        add_cell_batch(spark, "t_bad", deltas(spark, BATCHES[0]), 0)
    assert spark.table("t_bad_cells").count() == 0
    drop_cell_table(spark, "t_bad")


def test_every_metric_cell_by_sql(spark):
    df = store_queries.cell_table_sql(spark, SF_SMALL)
    assert {r["law"] for r in df.select("law").distinct().collect()} == {SUM, UNION, LAST}
    assert "cell_table_sql" in oracle.BODIES
