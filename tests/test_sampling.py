from pyspark.sql import functions as F

from usagelake.operators import sampling


def test_exact_split(spark):
    w = spark.createDataFrame([("a", 1), ("b", 3), ("c", 6)], "k string, weight long")
    cum = sampling.weight_cumulative(w, "k")
    assert [(r["k"], r["lo"], r["hi"]) for r in cum.orderBy("k").collect()] == \
        [("a", 0, 1), ("b", 1, 4), ("c", 4, 10)]
    draws = spark.range(0, 10).select((F.col("id") + 1).alias("r"))
    got = {r["k"]: r["n"] for r in sampling.weighted_draw(draws, cum, "r", "k")
           .groupBy("k").agg(F.count("*").alias("n")).collect()}
    assert got == {"a": 1, "b": 3, "c": 6}


def _plain(weights, positions):
    out, hi = [], 0
    ranges = []
    for k, w in sorted(weights):
        ranges.append((hi, hi + w, k))
        hi += w
    for r in positions:
        out += [(r, k) for lo, up, k in ranges if lo < r <= up]
    return sorted(out)


def test_many_partitions_equal_a_plain_draw(spark):
    """One category holds 75 % of the weight, and half of the draws are of one position."""
    weights = [(k, k % 7 + 1) for k in range(500)]
    weights[100] = (100, 3 * sum(w for _, w in weights))
    w = spark.createDataFrame(weights, "k long, weight long")
    keep = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cum = sampling.weight_cumulative(w, "k")
        total = sampling.total_weight(cum)
        positions = [(i * 7919) % total + 1 for i in range(600)] + [12] * 600 + [0, total + 1]
        draws = spark.createDataFrame([(i, r) for i, r in enumerate(positions)] + [(9999, None)], "id long, r long")
        got = sampling.weighted_draw(draws, cum, "r", "k")
        assert got.columns == ["id", "r", "k"]
        assert sorted((r["r"], r["k"]) for r in got.collect()) == _plain(weights, positions)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", keep)


def test_zero_weights_never_drawn(spark):
    w = spark.createDataFrame([("a", 0), ("b", 2)], "k string, weight long")
    cum = sampling.weight_cumulative(w, "k")
    assert [r["k"] for r in cum.collect()] == ["b"]


def test_empty_weights_draw_nothing(spark):
    w = spark.createDataFrame([("a", 0)], "k string, weight long")
    cum = sampling.weight_cumulative(w, "k")
    draws = spark.range(0, 5).select(sampling.draw_position(F.col("id"), 0).alias("r"))
    drawn = sampling.weighted_draw(draws, cum, "r", "k")
    assert drawn.count() == 0 and dict(drawn.dtypes) == {"r": "bigint", "k": "string"}
