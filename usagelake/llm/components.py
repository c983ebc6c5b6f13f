"""Connected components of an edge table by alternating large-star and small-star rounds.

Every round is joins and partial aggregations over edges; nothing but two
numbers per round reaches the driver.  Rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from usagelake.llm.common import drop_staged, staged


def _state(edges: DataFrame):
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(r)


def components(edges: DataFrame) -> DataFrame:
    """Edges ``a, b`` (long) -> ``node, root`` where root is the smallest node reachable.

    Only nodes with an edge to another node appear.  Self-loops, repeated and
    reversed edges are allowed; rows with a null end are ignored; no edges give no rows.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    e = staged(e.distinct(), "edges")
    state = _state(e)
    while state[0]:
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        nxt = staged(small.select("e.*").where("a <> b").distinct(), "edges")
        new = _state(nxt)
        if new == state:
            drop_staged(nxt)
            break
        drop_staged(e)
        e, state = nxt, new
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
