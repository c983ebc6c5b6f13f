"""SKETCH cells: merged batches equal one pass, folds change nothing, errors stay in the bound."""

import pytest
from pyspark.sql import functions as F

from usagelake.operators import app
from usagelake.streaming.cells import LAST, SKETCH, SUM, UNION, CellStore, as_deltas, merge_sketch, sketch_deltas

SIZES = {"a": 3, "b": 700, "c": 40_000}


def members(spark, lo=0.0, hi=1.0):
    """Members ``lo`` to ``hi`` (shares) of every cell, each several times."""
    df = None
    for q, n in SIZES.items():
        part = spark.range(int(n * lo), int(n * hi)).select(
            F.lit("T").alias("tbl"), F.lit("r").alias("row_key"), F.lit("users").alias("family"), F.lit(q).alias("qualifier"),
            F.explode(F.array(F.col("id").cast("string"), F.col("id").cast("string"))).alias("member"))
        df = part if df is None else df.unionByName(part)
    return df.repartition(6)


def values(df):
    return {r["qualifier"]: int(r["value"]) for r in df.collect()}


def test_overlapping_batches_equal_one_pass(spark):
    batches = [members(spark, 0, 0.6), members(spark, 0.3, 0.9), members(spark, 0.9, 1)]
    deltas = sketch_deltas(batches[0])
    for b in batches[1:]:
        deltas = deltas.unionByName(sketch_deltas(b))
    got = values(merge_sketch(deltas, admin=False))
    assert got == values(merge_sketch(sketch_deltas(members(spark)), admin=False))
    assert got["a"] == 3
    for q, n in SIZES.items():
        assert abs(got[q] - n) <= 5 * 1.04 / 2**6 * n


def test_store_folds_deletes_and_refuses_puts(spark, scratch):
    store = CellStore(spark, scratch + "/store")
    store.create_table("T", {"users": SKETCH, "n": SUM, "names": UNION, "state": LAST})
    other = as_deltas(spark.createDataFrame([("T", "r", "n", "q", 4)], "tbl string, row_key string, family string, qualifier string, num long"))
    store.write_batch(sketch_deltas(members(spark, 0, 0.5)).unionByName(other), 0)
    store.write_batch(sketch_deltas(members(spark, 0.4, 1)), 1)
    before = sorted(tuple(r) for r in store.scan("T").collect())
    assert {r[3] for r in before} == {SKETCH, SUM}
    store.compact()
    store.purge(1)
    assert sorted(tuple(r) for r in store.scan("T").collect()) == before
    store.write_batch(sketch_deltas(members(spark, 0, 0.9)), 2)  # nobody new
    assert sorted(tuple(r) for r in store.scan("T").collect()) == before
    with pytest.raises(ValueError):
        store.put("T", "r", "users", "a", "1")
    with pytest.raises(KeyError):
        store.put_frame("T", spark.createDataFrame([("r", "users", "a", "1")], "row_key string, family string, qualifier string, value string"))
    store.delete_row("T", "r")
    assert store.scan("T").count() == 0
    store.write_batch(sketch_deltas(members(spark, 0, 1).where("qualifier = 'a'")), 3)
    assert [(r["qualifier"], r["value"]) for r in store.scan("T").collect()] == [("a", "3")]


def test_sketches_are_built_before_the_shuffle(spark):
    s = spark.range(10).select(F.lit("p").alias("package_name"), F.lit("d").alias("date"), F.col("id").cast("string").alias("user_id"))
    plan = app.app_daily_user_sketch(s)._jdf.queryExecution().executedPlan().toString()
    assert "partial_hll_sketch_agg" in plan and plan.count("Exchange") == 1
    assert [r["users"] for r in app.app_daily_user_estimate(app.app_daily_user_sketch(s)).collect()] == [10]
