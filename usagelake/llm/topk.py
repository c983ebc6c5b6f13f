"""Exact top-k search over binary codes by incremental multi-index hashing.

A 64-bit code is cut into SEGMENTS parts; the index lists, for every part, the
codes by the part's value.  With search radius r per part, every code within
SEGMENTS * (r + 1) - 1 bits of a query agrees with it in some part up to r bits
(pigeonhole).  Round r probes the values up to r bits from the query's parts and
keeps the codes whose whole distance is newly covered at r; a query leaves as
soon as its k-th verified distance is covered, whichever id asks.  Rows of one code
are one entry of the index, with their k + 1 smallest ids and the rows of each (k at
most): more can't be in any answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from usagelake.llm.common import staged

BITS = 64
SEGMENTS = 4
K = 10


def sign_codes(vectors: DataFrame, ident: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``id, code``: bit i is 1 where the i-th of the first 64 components is above 0.

    Null, NaN and missing components give 0; a null vector has no code and is left out.
    """
    e = F.col(column)
    parts = [F.when((F.get(e, F.lit(i)) > 0) & ~F.isnan(F.get(e, F.lit(i))), F.shiftleft(F.lit(1).cast("long"), i))
             .otherwise(F.lit(0).cast("long")) for i in range(BITS)]
    code = parts[0]
    for p in parts[1:]:
        code = code.bitwiseOR(p)
    return vectors.where(e.isNotNull()).select(F.col(ident).cast("long").alias("id"), code.alias("code"))


def _part(code, s: int, width: int):
    return F.shiftrightunsigned(code, s * width).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def ball(width: int, r: int):
    """All masks of ``width`` bits with at most ``r`` of them set: a constant array (at most 65,536 for 16 bits)."""
    return F.split(F.lit(",".join(str(m) for m in range(1 << width) if m.bit_count() <= r)), ",").cast("array<bigint>")


def first_ids(codes: DataFrame, k: int) -> DataFrame:
    """``code, ids``: the ``k + 1`` smallest ids of every code in order, each with its rows ``n`` (at most ``k``).

    No answer of ``k`` rows can hold more, whichever id asks.  Counted within salted parts
    first, so a code with a third of all rows, or an id with many, is no single task's.
    """
    salted = codes.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64)))
    counted = salted.groupBy("code", "salt", "id").agg(F.least(F.count("*"), F.lit(k)).alias("n"))
    part = Window.partitionBy("code", "salt").orderBy("id")
    few = counted.withColumn("place", F.row_number().over(part)).where(F.col("place") <= k + 1)
    whole = Window.partitionBy("code").orderBy("id")
    few = few.withColumn("place", F.row_number().over(whole)).where(F.col("place") <= k + 1)
    return few.groupBy("code").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("ids"))


def _first_groups(near: DataFrame, k: int) -> DataFrame:
    """Of ``q, distance, id, n`` the rows that an answer to ``q`` can hold, whichever id asks.

    These are the nearest ``k`` of an id, of the ``k + 1`` ids that come first by
    distance: ``k`` rows at least are left when one id's are taken away.
    """
    own = Window.partitionBy("q", "id").orderBy("distance")
    near = near.withColumn("place", F.row_number().over(own)).withColumn(
        "nearest", F.min("distance").over(Window.partitionBy("q", "id"))).where(F.col("place") <= k)
    ids = F.dense_rank().over(Window.partitionBy("q").orderBy("nearest", "id"))
    return near.withColumn("place", ids).where(F.col("place") <= k + 1).select("q", "distance", "id", "n")


def top_k(codes: DataFrame, queries: DataFrame, k: int = K, segments: int = SEGMENTS) -> DataFrame:
    """``query_id, rank, id, distance``: the ``k`` nearest other rows of every query row.

    ``codes`` and ``queries`` hold ``id, code``; a row is no answer to a query of its own
    id.  Order is by Hamming distance, then id; fewer than ``k`` answers only where
    there are fewer other rows.  An id may be that of many rows, of one code or of
    several: each is an answer of its own.  Rows with a null id or code are left out;
    queries that repeat are asked once, and each different code of an id is a query.
    """
    spark = codes.sparkSession
    width = BITS // segments
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    codes = codes.where("id is not null and code is not null")
    queries = queries.where("id is not null and code is not null").select("id", "code").distinct()
    segment = lambda c: F.explode(F.array(*[
        F.struct(F.lit(s).alias("s"), _part(F.col(c), s, width).alias("v")) for s in range(segments)]))
    index = staged(first_ids(codes, k).select("code", "ids", segment("code").alias("e")).select(
        "code", "ids", "e.s", "e.v"), "index")
    open_ = staged(queries.select(F.col("code").alias("q")).distinct(), "open")
    found = None
    for r in range(width + 1):
        covered = segments * (r + 1) - 1
        # a query becomes many probes: they are made in all tasks, however few files hold the queries
        probes = open_.repartition(tasks, "q").select("q", segment("q").alias("e")).select(
            "q", "e.s", F.explode(F.transform(ball(width, r), lambda m: F.col("e.v").bitwiseXOR(m))).alias("v"))
        away = F.bit_count(F.col("q").bitwiseXOR(F.col("code")))
        # Spark's size estimate does not know how many probes a query explodes to: never broadcast them
        hits = probes.hint("merge").join(index, (probes["s"] == index["s"]) & (probes["v"] == index["v"]) & (away > covered - segments) & (away <= covered)).select(
            "q", "code", "ids", away.alias("distance"))
        # a code is found by every part in which it is near; an id may have several codes at one distance
        near = hits.distinct().select("q", "distance", F.inline("ids")).groupBy("q", "distance", "id").agg(
            F.least(F.sum("n"), F.lit(k)).alias("n"))
        found = staged(_first_groups(near if found is None else near.unionByName(found), k), "found")
        rows = found.groupBy("q", "id").agg(F.sum("n").alias("n")).groupBy("q").agg(
            F.sum("n").alias("rows"), F.max("n").alias("most"))
        open_ = staged(open_.join(rows.where(F.col("rows") - F.col("most") >= k), "q", "left_anti"), "open")
        if r == width or not open_.take(1):
            break
    answers = queries.select(F.col("id").alias("query_id"), F.col("code").alias("q")).join(found, "q").where(
        "id <> query_id").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    rank = F.row_number().over(Window.partitionBy("query_id", "q").orderBy("distance", "id"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "distance")


def op10(vectors: DataFrame) -> DataFrame:
    """The K nearest codes of every row whose vec_id is divisible by 50, among all rows."""
    codes = staged(sign_codes(vectors), "sign-codes")
    return top_k(codes, codes.where(F.col("id") % 50 == 0))


ORACLE_SQL = f"""
WITH v AS (SELECT vec_id, list_transform(range(1, {BITS + 1}), lambda i:
    coalesce(embedding[i] > 0 AND NOT isnan(embedding[i]), false)) AS b
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL),
p AS (SELECT q.vec_id AS query_id, q.b, v.vec_id AS id,
    list_sum(list_transform(range(1, {BITS + 1}), lambda i: CASE WHEN q.b[i] <> v.b[i] THEN 1 ELSE 0 END))::INTEGER AS distance
  FROM (SELECT DISTINCT vec_id, b FROM v) q JOIN v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id, b ORDER BY distance, id)::INTEGER AS rank FROM p)
SELECT query_id, rank, id, distance FROM r WHERE rank <= {K}
"""
