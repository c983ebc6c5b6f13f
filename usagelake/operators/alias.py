"""Weighted draws through alias tables (Walker, Vose), built in Spark.

With N categories of total weight W, a table has N slots of mass W each.  A
slot belongs to one category up to ``own`` and to its alias beyond, and the
masses of a category over all slots sum to exactly N times its weight (all
arithmetic is on integers).  A draw is a uniform slot and a uniform mass: one
equi-join on the slot, in which every slot gets the same share of the draws.

Building: a category lighter than a slot (N w < W) leaves a deficit, a heavier
one has a surplus.  Deficits and surpluses are laid end to end in key order.
The heavy category whose surplus covers the start of a light one's deficit
fills that slot whole; if that overdraws its surplus, its own slot is short by
the difference, which the next heavy category fills.  Both rules only need
running sums and the nearest row of the other kind, which are taken over
range-partitioned rows with one carried row for each partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from usagelake.functions.random import uniform_int
from usagelake.operators.sampling import _ranged, weight_rollup

EXACT = "decimal(38,0)"


def _carried(ranged: DataFrame, group: list[str], name: str, value: Column, fold, back: bool = False) -> DataFrame:
    """Per partition ``_pid`` and border group: ``fold`` of ``value`` over the group's earlier partitions.

    Only the first and the last group of a partition can go on in another one, so the result
    has at most two rows for each partition: a proven bound for a broadcast.
    """
    ends = ranged.groupBy("_pid").agg(F.min(F.struct(*group)).alias("a"), F.max(F.struct(*group)).alias("b"))
    ends = ends.select("_pid", F.explode(F.array_distinct(F.array("a", "b"))).alias("g")).select("_pid", "g.*")
    own = ranged.join(F.broadcast(ends), ["_pid", *group], "left_semi").groupBy("_pid", *group).agg(value.alias("_v"))
    order = F.desc("_pid") if back else F.asc("_pid")
    before = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return own.select("_pid", *group, fold(F.col("_v"), before).alias(name))


def _sum(v: Column, w) -> Column:
    return F.coalesce(F.sum(v).over(w), F.lit(0).cast(EXACT))


def _nearest(v: Column, w) -> Column:
    return F.last(v, ignorenulls=True).over(w)


def alias_table(weights: DataFrame, keys, parent=(), weight_col: str = "weight") -> DataFrame:
    """Alias table of the categories ``keys``, one for each value of the columns ``parent``.

    Columns: ``*parent, slot`` (0 to n - 1 in key order), ``*keys, weight, own, alias`` (a struct of the
    keys, null where the slot is all its own), ``n`` and ``total`` of the table.  Weights of equal
    keys are summed; zero and negative sums and null parents are left out; no weight gives no rows.
    """
    keys, parent = ([c] if isinstance(c, str) else list(c) for c in (keys, parent))
    w = weight_rollup(weights, parent + keys, weight_col).withColumn("_g", F.lit(0))
    group = ["_g", *parent]
    sums = w.groupBy(*group).agg(F.count("*").alias("n"), F.sum("weight").cast("bigint").alias("total"))
    if parent:
        w = w.join(sums, group)
    else:  # one row: two numbers
        r = sums.first()
        w = w.select("*", *[F.lit(r[c] if r else None).cast("bigint").alias(c) for c in ("n", "total")])
    over = F.col("weight").cast(EXACT) * F.col("n") - F.col("total")
    parts = {"_light": F.greatest(-over, F.lit(0)), "_heavy": F.greatest(over, F.lit(0)), "slot": F.lit(1)}
    ranged = _ranged(w.select(*w.columns, *[v.cast(EXACT).alias(c) for c, v in parts.items()]), *group, *keys)
    here = (Window.partitionBy("_pid", *group).orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    x = ranged
    for c in parts:
        carry = _carried(ranged, group, "_off", F.sum(c), _sum)
        x = x.join(F.broadcast(carry), ["_pid", *group], "left")
        x = x.withColumn(f"_end{c}", F.sum(c).over(here) + F.coalesce("_off", F.lit(0).cast(EXACT))).drop("_off")
    x = x.withColumn("slot", (F.col("_endslot") - 1).cast("bigint"))
    light = F.col("_light") > 0
    heavy = F.col("_heavy") > 0
    # a light row stands where its deficit starts, a heavy one where its surplus ends, before light rows there
    x = x.select(*group, *keys, "weight", "n", "total", "slot", (~light).alias("_even"), heavy.alias("_h"),
                 F.when(light, F.col("_end_light") - F.col("_light")).otherwise(F.col("_end_heavy")).alias("_pos"),
                 F.when(light, 1).otherwise(0).alias("_kind"), F.when(light, F.col("_end_light")).alias("_deficit"),
                 F.when(heavy, F.struct(*keys)).alias("_who"))
    at = ["_pos", "_kind", "slot"]
    ranged = _ranged(x, *group, *at)
    up = Window.partitionBy("_pid", *group).orderBy(*at).rowsBetween(Window.unboundedPreceding, -1)
    down = (Window.partitionBy("_pid", *group).orderBy(*[F.desc(c) for c in at])
            .rowsBetween(Window.unboundedPreceding, -1))
    last = _carried(ranged, group, "_c1", F.max("_deficit"), _nearest)
    order = F.when(F.col("_h"), F.struct(*at))
    following = _carried(ranged, group, "_c2", F.min_by("_who", order), _nearest, back=True)
    y = ranged.join(F.broadcast(last), ["_pid", *group], "left").join(F.broadcast(following), ["_pid", *group], "left")
    y = y.withColumn("_before", F.coalesce(_nearest(F.col("_deficit"), up), F.col("_c1")))
    y = y.withColumn("_next", F.coalesce(_nearest(F.col("_who"), down), F.col("_c2")))
    short = F.when(F.col("_h"), F.col("_before") - F.col("_pos")).otherwise(F.lit(0).cast(EXACT))
    short = F.greatest(F.coalesce(short, F.lit(0).cast(EXACT)), F.lit(0).cast(EXACT))
    own = F.when(F.col("_even"), F.col("total") - short).otherwise(F.col("weight").cast(EXACT) * F.col("n"))
    y = y.withColumn("own", own.cast("bigint"))
    alias = F.when(F.col("own") < F.col("total"), F.col("_next")).alias("alias")
    return y.select(*parent, "slot", *keys, "weight", "own", alias, "n", "total")


def alias_draw(draws: DataFrame, table: DataFrame, key: str, keys, seed: int = 0, stream: str = "draw") -> DataFrame:
    """Each row of ``draws`` with a category of ``table`` (without parents), drawn by its column ``key``.

    ``key`` should tell rows apart: rows of one key draw the same category.  An empty table draws nothing.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    size = table.select("n", "total").first()
    n, total = (size["n"], size["total"]) if size else (0, 0)
    rows = draws.select(F.struct(*draws.columns).alias("_row"), F.col(key).alias("_key"))
    rows = rows.withColumn("slot", uniform_int(n, "_key", seed, f"{stream}/slot"))
    slots = table.select("slot", F.struct("own", *keys, "alias").alias("_t"))
    hit = uniform_int(total, "_key", seed, f"{stream}/mass") < F.col("_t.own")
    return rows.join(slots, "slot").select("_row.*", *[
        F.when(hit, F.col(f"_t.{k}")).otherwise(F.col(f"_t.alias.{k}")).alias(k) for k in keys])


def alias_hierarchical_draw(draws: DataFrame, weights: DataFrame, parent: str, child: str, key: str, seed: int = 0,
                            weight_col: str = "weight") -> DataFrame:
    """Draw a parent by its summed weight, then a child within it, each through its alias table.

    A parent with much weight and few children would make its few slots hot.  Its table is therefore
    repeated ``copies`` times, so that no slot gets more than one N-th of the draws, N being the
    number of all children; that at most doubles the rows.
    """
    kids = alias_table(weights, child, parent, weight_col)
    top = kids.groupBy(parent).agg(F.max("total").alias("weight"), F.max("n").alias("_n"))
    parents = alias_table(top, parent)
    r = top.agg(F.sum("weight"), F.sum("_n")).first()
    weight, leaves = (int(v or 0) for v in r)
    copies = F.expr(f"(cast(weight as decimal(19,0)) * {leaves} + cast(_n as decimal(19,0)) * {weight} - 1)"
                    f" div (cast(_n as decimal(19,0)) * {max(weight, 1)})")
    info = top.select(F.col(parent).alias("_p"), "_n", F.col("weight").alias("_w"), copies.alias("_copies"))
    named = parents.join(info, F.col(parent) == F.col("_p")).select(parents["*"], F.struct("_n", "_w", "_copies").alias("_own"))
    beyond = info.select(F.struct(F.col("_p").alias(parent)).alias("_a"), F.struct("_n", "_w", "_copies").alias("_beyond"))
    named = named.join(beyond, F.col("alias") == F.col("_a"), "left").drop("_a")
    rows = draws.select(F.struct(*draws.columns).alias("_row"), F.col(key).alias("_key"))
    rows = rows.withColumn("slot", uniform_int(parents.count(), "_key", seed, "parent/slot"))
    first = rows.join(named.select("slot", parent, "own", "alias", "_own", "_beyond"), "slot")
    hit = uniform_int(weight, "_key", seed, "parent/mass") < F.col("own")
    first = first.select("_row", "_key", F.when(hit, F.col(parent)).otherwise(F.col(f"alias.{parent}")).alias("_p"),
                         F.when(hit, F.col("_own")).otherwise(F.col("_beyond")).alias("_i"))
    at = uniform_int(F.col("_i._n") * F.col("_i._copies"), "_key", seed, "child/slot")
    second = first.withColumn("_at", at).select("*", F.pmod("_at", F.col("_i._n")).alias("slot"),
                                                F.floor(F.col("_at") / F.col("_i._n")).cast("bigint").alias("_copy"))
    spread = kids.join(info.select("_p", "_copies"), F.col(parent) == F.col("_p")).select(
        F.col(parent).alias("_p"), "slot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1)).alias("_copy"),
        F.struct("own", child, "alias").alias("_t"))
    drawn = second.join(spread, ["_p", "slot", "_copy"])
    mass = uniform_int(F.col("_i._w"), "_key", seed, "child/mass")
    return drawn.select("_row.*", F.col("_p").alias(parent), F.when(mass < F.col("_t.own"), F.col(f"_t.{child}"))
                        .otherwise(F.col(f"_t.alias.{child}")).alias(child))
