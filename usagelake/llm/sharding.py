"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly.

Groups are equal texts.  Groups are dealt by hash into a fixed number of
bundles; a group too large for a bundle is an item by itself and is cut into
pieces by document.  Items carry a load vector (bytes, tokens, rows) and go,
largest first, to the shard where the dot product of the load with the shard's
residual capacity is highest.  The number of items has a fixed bound, whatever
the input, so the placement is a small table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from usagelake.llm.common import staged
from usagelake.llm.mixing import WORD

SHARDS = 40
BUNDLES = 16_384
OVERHEAD = 16
PIECES_PER_SHARD = 4
ROWS_PER_RUN = 200_000
LOADS = ["size", "tokens", "n"]


def place(loads: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every item (rows of ``loads``): highest dot product with residual capacity.

    Loads are scaled so that one shard's capacity is 1 in every dimension; the first
    dimension, which the law is about, counts for most.  Ties go to the lowest shard.
    """
    total = loads.sum(axis=0)
    unit = loads / np.where(total > 0, total, 1) * shards
    weight = np.array([1.0] + [0.05] * (loads.shape[1] - 1))
    room = np.ones((shards, loads.shape[1]))
    out = np.zeros(len(loads), np.int64)
    for i in np.lexsort((np.arange(len(unit)), -(unit * weight).sum(axis=1))):
        out[i] = k = int((room @ (unit[i] * weight)).argmax())
        room[k] -= unit[i]
    return out


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, tokens, shard, slot`` for every row.

    ``size`` is the text's UTF-8 bytes plus OVERHEAD; a null text counts as empty.
    Equal texts share a shard unless their group is too large for one item.  Slots
    count from 0 in each shard without gaps.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = staged(docs.select(
        F.col("doc_id").cast("long"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"),
        F.xxhash64(text).alias("h")), "shard-rows")
    key = ["h", "text_crc32", "size"]
    groups = rows.groupBy(*key).agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    whole = rows.agg(F.sum("size"), F.count("*")).first()
    most_bytes, most_rows = ((x or 0) / (shards * PIECES_PER_SHARD) for x in whole)
    # at most 2 * shards * PIECES_PER_SHARD groups can be above either limit, so this side is bounded
    large = groups.where((F.col("n") > 1) & ((F.col("bytes") > most_bytes) | (F.col("n") > most_rows))).select(
        *key, F.ceil(F.greatest(F.col("bytes") / most_bytes, F.col("n") / most_rows)).alias("pieces"))
    spread = rows.join(F.broadcast(large), key, "left")
    item = F.when(F.col("pieces").isNull(), F.pmod(F.xxhash64(*key), F.lit(BUNDLES))).otherwise(
        BUNDLES + F.pmod(F.xxhash64(*key), F.lit(1 << 40)) * (1 << 20)
        + F.pmod(F.xxhash64("doc_id"), F.col("pieces")))
    spread = spread.withColumn("item", item)
    # at most BUNDLES + 4 * shards * PIECES_PER_SHARD items: a bounded table
    items = spread.groupBy("item").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"),
                                       F.count("*").alias("n")).orderBy("item").collect()
    loads = np.array([[r[c] for c in LOADS] for r in items], float).reshape(-1, len(LOADS))
    shard = place(loads, shards)
    table = spark.createDataFrame([(r["item"], int(s)) for r, s in zip(items, shard)], "item long, shard int")
    runs = max(1, -(-(whole[1] or 0) // (ROWS_PER_RUN * shards))) * 8
    dealt = staged(spread.join(F.broadcast(table), "item").select(
        "doc_id", "size", "text_crc32", "tokens", "shard", "h",
        F.pmod(F.xxhash64("doc_id", "h"), F.lit(runs)).alias("run")), "shard-dealt")
    # slots: place within a run of the shard, plus the rows of the runs before it
    sizes = dealt.groupBy("shard", "run").count()
    before = sizes.select("shard", "run", (F.sum("count").over(
        Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, 0))
        - F.col("count")).alias("before"))
    at = F.row_number().over(Window.partitionBy("shard", "run").orderBy("doc_id", "h")) - 1
    return dealt.withColumn("at", at).join(before, ["shard", "run"]).select(
        "doc_id", "size", "text_crc32", "tokens", "shard", (F.col("at") + F.col("before")).cast("long").alias("slot"))


def op3(docs: DataFrame) -> DataFrame:
    """The contract's columns under the law ``bytes``."""
    return sharded(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                F.lit(None).cast("int").alias("grown_shard"))
