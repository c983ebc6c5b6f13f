"""Counter-based integers and alias tables: exact masses, plain versions, fixed values."""

import hashlib
import random
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from usagelake.functions.random import uniform_int
from usagelake.operators import alias


def plain_uniform(n, key, seed, stream, digits=15, attempts=2):
    value = None
    for i in range(attempts):
        digest = hashlib.md5(f"{seed}|{stream}|{i // 2}|{key}".encode()).hexdigest()
        value = int(digest[i % 2 * 15:][:digits], 16)
        if value < 16**digits - 16**digits % n:
            break
    return value % n


def test_uniform_int_equals_plain_arithmetic(spark):
    df = spark.range(400).repartition(7).select("id", uniform_int(1000, "id", 5, "s").alias("a"),
                                                uniform_int(F.col("id") + 1, "id", 5, "t").alias("b"),
                                                uniform_int(10, "id", 5, "u", digits=1, attempts=6).alias("c"))
    for r in df.collect():
        assert r["a"] == plain_uniform(1000, r["id"], 5, "s")
        assert r["b"] == plain_uniform(r["id"] + 1, r["id"], 5, "t")
        assert r["c"] == plain_uniform(10, r["id"], 5, "u", 1, 6)


def test_values_do_not_depend_on_partitions(spark):
    ids = spark.range(1000)
    got = [sorted(tuple(r) for r in d.select("id", uniform_int(77, "id").alias("r")).collect())
           for d in (ids, ids.repartition(13), ids.orderBy(F.desc("id")).coalesce(1))]
    assert got[0] == got[1] == got[2]


def _chi_square(df, n, rows):
    seen = {r["v"]: r["n"] for r in df.groupBy("v").agg(F.count("*").alias("n")).collect()}
    assert set(seen) <= set(range(n))
    return sum((seen.get(i, 0) - rows / n) ** 2 / (rows / n) for i in range(n))


def test_chi_square(spark):
    """99.99 % bounds of chi-square with 9 and 99 degrees of freedom; one digit has 16 values, so 10 needs rejection."""
    ids = spark.range(40_000)
    assert _chi_square(ids.select(uniform_int(100, "id", 3).alias("v")), 100, 40_000) < 161.3
    fair = ids.select(uniform_int(10, "id", 3, digits=1, attempts=16).alias("v"))
    assert _chi_square(fair, 10, 40_000) < 33.8
    unfair = ids.select(uniform_int(10, "id", 3, digits=1, attempts=1).alias("v"))
    assert _chi_square(unfair, 10, 40_000) > 1000


def test_no_size_gives_null(spark):
    rows = spark.createDataFrame([(1, 0), (2, -3), (3, None), (4, 1), (None, 5)], "k long, n long")
    got = [r["v"] for r in rows.select("k", uniform_int(F.col("n"), "k").alias("v")).orderBy(F.col("k").asc_nulls_last()).collect()]
    assert got[:4] == [None, None, None, 0] and got[4] in range(5)


def plain_table(weights):
    """Alias table by the sequential sweep: lights in key order against heavies in key order."""
    cats = sorted((k, w) for k, w in weights.items() if w > 0)
    n, total = len(cats), sum(w for _, w in cats)
    own = {k: w * n for k, w in cats}
    lights = [k for k, _ in cats if own[k] < total]
    heavies = [k for k, _ in cats if own[k] > total]
    out, rest = {k: (total, None) for k, _ in cats}, dict(own)
    h = 0
    for k in lights:
        out[k] = (own[k], heavies[h])
        rest[heavies[h]] -= total - own[k]
        while h < len(heavies) and rest[heavies[h]] < total:
            if h + 1 < len(heavies):
                out[heavies[h]] = (rest[heavies[h]], heavies[h + 1])
                rest[heavies[h + 1]] -= total - rest[heavies[h]]
            h += 1
        while h < len(heavies) and rest[heavies[h]] == total and k != lights[-1]:
            h += 1
    return out


def masses(rows, keys=("k",)):
    """Mass of each category over all slots, in slots' units."""
    out = defaultdict(int)
    for r in rows:
        out[tuple(r[k] for k in keys)] += r["own"]
        if r["own"] < r["total"]:
            out[tuple(r["alias"][k] for k in keys)] += r["total"] - r["own"]
    return out


@pytest.mark.parametrize("seed", range(4))
def test_masses_are_exact_over_many_partitions(spark, seed):
    rng = random.Random(seed)
    weights = {k: rng.choice([1, 2, 3, 50, rng.randint(1, 10**12)]) for k in range(300)}
    weights[17] = 0
    weights[40] = 10**15
    if seed == 3:
        weights = {k: 6 if k % 2 else 2 for k in range(300)}  # surpluses end where deficits end
    keep = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(list(weights.items()), "k long, weight long").repartition(5)
        rows = alias.alias_table(df, "k").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", keep)
    live = {k: w for k, w in weights.items() if w > 0}
    assert sorted(r["slot"] for r in rows) == list(range(len(live)))
    assert [r["k"] for r in sorted(rows, key=lambda r: r["slot"])] == sorted(live)
    assert masses(rows) == {(k,): w * len(live) for k, w in live.items()}
    assert {r["k"]: (r["own"], r["alias"]["k"] if r["alias"] else None) for r in rows} == plain_table(weights)


def test_tables_by_parent(spark):
    rng = random.Random(1)
    rows = [(p, k, rng.randint(1, 90)) for p in ("a", "b", "c") for k in range({"a": 1, "b": 40, "c": 200}[p])]
    df = spark.createDataFrame(rows, "p string, k long, weight long")
    got = alias.alias_table(df, "k", "p").collect()
    for p in "abc":
        own = {k: w for q, k, w in rows if q == p}
        part = [r for r in got if r["p"] == p]
        assert masses(part) == {(k,): w * len(own) for k, w in own.items()}
        assert {(r["n"], r["total"]) for r in part} == {(len(own), sum(own.values()))}


def test_draw_is_an_equi_join_without_window_or_checkpoint(spark):
    t = alias.alias_table(spark.createDataFrame([(k, k + 1) for k in range(50)], "k long, weight long"), "k")
    t.write.mode("overwrite").saveAsTable("alias_of_test")
    try:
        drawn = alias.alias_draw(spark.range(1000), spark.table("alias_of_test"), "id", "k")
        plan = drawn._jdf.queryExecution().optimizedPlan().toString()
        assert "Join Inner, (slot" in plan and "Window" not in plan and "LogicalRDD" not in plan
    finally:
        spark.sql("DROP TABLE alias_of_test")


def test_draws_follow_the_weights(spark):
    weights = {"a": 1, "b": 3, "c": 6, "d": 30}
    t = alias.alias_table(spark.createDataFrame(list(weights.items()), "k string, weight long"), "k")
    n = 40_000
    got = {r["k"]: r["n"] for r in alias.alias_draw(spark.range(n), t, "id", "k", seed=9)
           .groupBy("k").agg(F.count("*").alias("n")).collect()}
    chi = sum((got[k] - n * w / 40) ** 2 / (n * w / 40) for k, w in weights.items())
    assert chi < 21.2  # 99.99 % of chi-square with 3 degrees of freedom


def test_hierarchical_draw_follows_the_weights(spark):
    """One parent holds 80 % of the weight with two children; another has 50 light ones."""
    rows = [("big", "x", 300), ("big", "y", 100)] + [("many", f"c{i:02}", 2) for i in range(50)]
    df = spark.createDataFrame(rows, "p string, c string, weight long")
    n = 40_000
    drawn = alias.alias_hierarchical_draw(spark.range(n), df, "p", "c", "id", seed=2)
    assert drawn.columns == ["id", "p", "c"]
    got = {(r["p"], r["c"]): r["n"] for r in drawn.groupBy("p", "c").agg(F.count("*").alias("n")).collect()}
    chi = sum((got.get((p, c), 0) - n * Fraction(w, 500)) ** 2 / (n * Fraction(w, 500)) for p, c, w in rows)
    assert sum(got.values()) == n and chi < 98  # 99.99 % with 51 degrees of freedom


def test_nothing_to_draw(spark):
    none = spark.createDataFrame([("a", "x", 0)], "p string, c string, weight long")
    t = alias.alias_table(none, "c")
    assert t.count() == 0 and alias.alias_draw(spark.range(3), t, "id", "c").count() == 0
    assert alias.alias_hierarchical_draw(spark.range(3), none, "p", "c", "id").count() == 0
