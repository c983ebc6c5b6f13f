"""Weighted draws from dimension tables.

A category is drawn with probability proportional to its integer weight:
weights are laid end to end on ``1..total`` (category i owns the positions
``lo < r <= hi``) and a draw position ``r`` picks the category whose range
holds it.  Draw positions come from input columns (``draw_position``) so a
draw is reproducible and checkable; nothing here collects categories or
draws to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from usagelake.session import reusable


def draw_position(key, total: int, multiplier: int = 7919) -> Column:
    """Deterministic draw in ``1..total`` from an integer key column.

    With ``total == 0`` (no positive weight) the position is NULL, which
    matches no category.
    """
    if int(total) <= 0:
        return F.lit(None).cast("bigint")
    k = F.col(key) if isinstance(key, str) else key
    return (F.pmod(k.cast("bigint") * F.lit(multiplier), F.lit(int(total))) + 1).cast("bigint")


def weight_rollup(weights: DataFrame, keys, weight_col: str = "weight") -> DataFrame:
    """Summed weight per key -> ``*keys, weight`` (zero and negative weights dropped)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return (weights.groupBy(*keys).agg(F.sum(weight_col).cast("bigint").alias("weight"))
            .filter(F.col("weight") > 0))


def total_weight(cum: DataFrame) -> int:
    """Sum of all weights (one number to the driver)."""
    v = cum.agg(F.sum("weight")).first()[0]
    return int(v or 0)


def _ranged(df: DataFrame, *order: str) -> DataFrame:
    """``df`` range-partitioned by ``order``, with its partition number in ``_pid``.

    Written once to the shared folder, so the numbers stay fixed on
    recomputation; partitions are balanced, and AQE merges small ones.
    """
    return reusable(df.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id()))


def weight_cumulative(weights: DataFrame, keys, weight_col: str = "weight") -> DataFrame:
    """Running weight ranges in key order -> ``*keys, weight, lo, hi``.

    Categories are folded per key, range-partitioned by key and summed within
    each partition; the totals of the partitions before (one row per
    partition) are added.  The same path serves any number of categories.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    ranged = _ranged(weight_rollup(weights, keys, weight_col), *keys)
    win = Window.partitionBy("_pid").orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = ranged.groupBy("_pid").agg(F.sum("weight").alias("_t"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"))
    # one row per partition: a proven bound for the broadcast
    c = ranged.withColumn("_run", F.sum("weight").over(win)).join(F.broadcast(offsets), "_pid").withColumn(
        "hi", (F.col("_run") + F.col("_off")).cast("bigint"))
    return c.withColumn("lo", F.col("hi") - F.col("weight")).select(*keys, "weight", "lo", "hi")


def weighted_draw(draws: DataFrame, cum: DataFrame, draw_col: str, keys, keep: dict | None = None) -> DataFrame:
    """Attach to each draw row the category whose range holds ``draw_col``.

    Categories (at the first position of their range) and draws are put in one
    order by position and range-partitioned; a draw belongs to the last
    category at or before it in its partition, or else to the last one of the
    partitions before.  Draws of one position are told apart by a hash of the
    row, so neither a heavy category nor a position drawn by many rows lands
    in one task.  ``keep`` maps further columns of ``cum`` to output names.
    Draws outside every range (and NULL draws) are left out.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    keep = keep or {}
    cat = F.struct(*keys, "lo", "hi", *[F.col(c).alias("_keep_" + n) for c, n in keep.items()])
    row = F.struct(*draws.columns)
    starts = cum.select((F.col("lo") + 1).alias("_pos"), F.lit(0).alias("_kind"), F.lit(0).cast("bigint").alias("_h"),
                        cat.alias("_cat"))
    rows = draws.filter(F.col(draw_col).isNotNull()).select(
        F.col(draw_col).cast("bigint").alias("_pos"), F.lit(1).alias("_kind"), F.xxhash64(row).alias("_h"),
        row.alias("_row"))
    ranged = _ranged(starts.unionByName(rows, allowMissingColumns=True), "_pos", "_kind", "_h")
    last = ranged.groupBy("_pid").agg(F.max_by("_cat", F.when(F.col("_kind") == 0, F.col("_pos"))).alias("_last"))
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: a proven bound for the broadcast
    carry = last.select("_pid", F.last("_last", ignorenulls=True).over(earlier).alias("_carry"))
    here = (Window.partitionBy("_pid").orderBy("_pos", "_kind")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    x = ranged.withColumn("_own", F.last("_cat", ignorenulls=True).over(here)).filter(F.col("_kind") == 1)
    x = x.join(F.broadcast(carry), "_pid").withColumn("_c", F.coalesce("_own", "_carry"))
    x = x.filter((F.col("_pos") > F.col("_c.lo")) & (F.col("_pos") <= F.col("_c.hi")))
    return x.select("_row.*", *[F.col(f"_c.{k}").alias(k) for k in keys],
                    *[F.col(f"_c._keep_{n}").alias(n) for n in keep.values()])


def hierarchical_draw(draws: DataFrame, weights: DataFrame, parent: str, child: str,
                      parent_draw: str, child_draw_key: str, weight_col: str = "weight",
                      child_multiplier: int = 104729) -> DataFrame:
    """Draw a parent by its summed weight, then a child within that parent.

    Children are laid out in (parent, child) order, so a parent's children
    occupy one contiguous stretch of the global child ranges, starting at the
    parent's own ``lo``, which the first draw carries along with the parent's
    weight.  The second draw is ``pmod(key * m, parent_total) + 1`` shifted by
    that start.  ``parent_draw`` must already hold a position in ``1..total``.
    """
    kids = weight_cumulative(weights, [parent, child], weight_col)
    par = kids.groupBy(parent).agg(F.sum("weight").cast("bigint").alias("weight"), F.min("lo").alias("lo"),
                                   F.max("hi").alias("hi"))
    first = weighted_draw(draws, par, parent_draw, [parent], keep={"lo": "_plo", "weight": "_ptot"})
    k = F.col(child_draw_key).cast("bigint")
    second = first.withColumn("_r2", F.col("_plo") + F.pmod(k * F.lit(child_multiplier), F.col("_ptot")) + 1)
    kids_side = kids.select(F.col(parent).alias("_kp"), child, "weight", "lo", "hi")
    out = weighted_draw(second, kids_side, "_r2", ["_kp", child])
    return out.filter(F.col("_kp") == F.col(parent)).drop("_kp", "_r2", "_plo", "_ptot")
