"""Line dedup over levelled sorted runs of line hashes.

A line's key is the line without white space at its ends and with A-Z lower-cased; keys
are held as 128 bits of hash (two 64-bit hashes with different seeds).

``LineRuns`` holds what is known about keys so far as runs: tables sorted and bucketed by
key, one row a key.  A batch of keys is merge-joined with the runs, bucket by bucket: its
keys without a partner (the anti-join) are new and name the document that keeps the line;
the others only add to the counts.  The batch then becomes a run of level 0.  When a level
holds two runs, they are merged into one run of the next level, so a key is rewritten once
a level and a batch meets few runs.  Neither step shuffles a run: only the new batch moves.

All steps are DataFrame operations; nothing but a few numbers reaches the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from usagelake.llm.common import by_weight, delete_folder, drop_staged, staged
from usagelake.session import shared_dir

MIN_LENGTH = 40
MIN_DOCS = 5
BATCHES = 4
ROWS_PER_BUCKET = 200_000
MOST_BUCKETS = 50_000  # Spark refuses bucketed tables of more than 100,000
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without ``[\\x20\\x09-\\x0D]`` at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


class LineRuns:
    """Sorted runs of keys by level: ``h1, h2, n_docs, n_lines, keeper``, one row a key and run.

    ``keeper`` is null in a run whose key an earlier run already had.  The runs are bucketed
    tables in the shared folder.  Batches must not share documents.
    """

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark = spark
        self.buckets = buckets
        self.levels: list[list[tuple[str, str]]] = []

    def _write(self, df: DataFrame) -> tuple[str, str]:
        name = f"llm_lines_{uuid.uuid4().hex}"
        path = shared_dir(self.spark, name.replace("_", "-"))
        (df.write.format("parquet").bucketBy(self.buckets, *KEY).sortBy(*KEY)
         .option("path", path).saveAsTable(name))
        return name, path

    def _drop(self, run: tuple[str, str]) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {run[0]}")
        delete_folder(self.spark, run[1])

    def runs(self) -> list[tuple[str, str]]:
        return [r for level in self.levels for r in level]

    def add(self, keys: DataFrame) -> None:
        """Add a batch ``h1, h2, n_docs, n_lines, last``, one row a key."""
        keys = keys.repartition(self.buckets, *KEY)
        for i, (name, _) in enumerate(self.runs()):
            keys = keys.join(self.spark.table(name).select(*KEY, F.lit(True).alias(f"in{i}")), KEY, "left")
        seen = F.coalesce(*[F.col(f"in{i}") for i in range(len(self.runs()))], F.lit(False))
        self._put(0, self._write(keys.select(
            *KEY, "n_docs", "n_lines", F.when(~seen, F.col("last")).alias("keeper"))))

    def _put(self, level: int, run: tuple[str, str]) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == 2:
            pair, self.levels[level] = self.levels[level], []
            self._put(level + 1, self._merged(*pair))

    def _merged(self, a: tuple[str, str], b: tuple[str, str]) -> tuple[str, str]:
        """One run of two; they are merged bucket by bucket."""
        x, y = self.spark.table(a[0]).alias("x"), self.spark.table(b[0]).alias("y")
        both = x.join(y, KEY, "full").select(
            *KEY, *[(F.coalesce(f"x.{c}", F.lit(0)) + F.coalesce(f"y.{c}", F.lit(0))).alias(c)
                    for c in ("n_docs", "n_lines")],
            F.coalesce("x.keeper", "y.keeper").alias("keeper"))
        run = self._write(both)
        self._drop(a)
        self._drop(b)
        return run

    def folded(self) -> DataFrame:
        """All runs as one: one row a key, with its counts over all batches and its keeper."""
        runs = self.runs()
        if not runs:
            raise ValueError("no batch was added")
        last = runs[0]
        for run in runs[1:]:
            last = self._merged(last, run)
        self.levels = [[] for _ in self.levels] + [[last]]
        return self.spark.table(last[0])

    def drop(self) -> None:
        for run in self.runs():
            self._drop(run)
        self.levels = []


def _batch(bounds: list[int]) -> Column:
    """Number of a document's batch; larger doc_ids come first, null doc_ids last."""
    n = F.lit(len(bounds))
    for b in bounds:
        n = n - F.when(F.col("d") >= F.lit(b), 1).otherwise(0)
    return n


def repeated_lines(docs: DataFrame, min_length: int = MIN_LENGTH, min_docs: int = MIN_DOCS,
                   batches: int = BATCHES) -> DataFrame:
    """Lines to drop -> ``d`` (doc_id), ``t`` (hash of the text), ``drop`` (their places, from 0).

    Documents come in ``batches`` batches by falling doc_id, so the first document that
    brings a key to the runs is the largest that has it.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    cut = docs.select(F.col("doc_id").alias("d"), F.xxhash64(text).alias("t"),
                      F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    cut = cut.select("d", "t", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_length)
    lines = staged(cut.select("d", "t", "pos", F.xxhash64("key").alias("h1"),
                              F.xxhash64(F.lit(1), "key").alias("h2")), "lines")
    shares = [i / batches for i in range(1, batches)]
    total, bounds = lines.agg(F.count("*"), F.percentile_approx("d", shares) if shares else F.lit(None)).first()
    bounds = sorted(set(bounds or []))
    runs = LineRuns(spark, min(-(-total // ROWS_PER_BUCKET) or 1, MOST_BUCKETS))
    try:
        for i in range(len(bounds) + 1):
            own = (lines.where(_batch(bounds) == i).groupBy(*KEY, "d").agg(F.count("*").alias("n"))
                   .groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.sum("n").alias("n_lines"), F.max("d").alias("last")))
            runs.add(own)
        common = runs.folded().where(F.col("n_docs") >= min_docs).select(*KEY, "n_lines", "keeper")
        out = by_weight(lines, common, KEY, "n_lines", total).where(~F.col("d").eqNullSafe(F.col("keeper")))
        return staged(out.groupBy("d", "t").agg(F.collect_set("pos").alias("drop")), "line-drops")
    finally:
        runs.drop()
        drop_staged(lines)


def cleaned(docs: DataFrame, min_length: int = MIN_LENGTH, min_docs: int = MIN_DOCS,
            batches: int = BATCHES) -> DataFrame:
    """Every document without the lines that at least ``min_docs`` documents share ->
    ``doc`` (a struct of the document's columns), ``text``, ``n_lines``, ``n_dropped``.

    A key of at least ``min_length`` code points found in ``min_docs`` documents keeps its
    lines in the largest doc_id that has it (all of them) and loses the others.  Rows of one
    doc_id are one document: their lines count once, and all of them keep a line or none.
    Rows without a doc_id are together one document, smaller than all others.  Null texts are
    empty, an empty text is one empty line.  An empty table gives no rows; columns beside
    ``doc_id`` and ``text`` may have any names.
    """
    drops = repeated_lines(docs, min_length, min_docs, batches)
    text = F.coalesce(F.col("doc.text"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    rows = rows.select("doc", F.split(text, "\n", -1).alias("lines"), F.xxhash64(text).alias("t_"))
    out = rows.join(drops, F.col("doc.doc_id").eqNullSafe(F.col("d")) & (F.col("t_") == F.col("t")), "left")
    n = F.size("lines")
    places = F.array_except(F.sequence(F.lit(0), n - 1), F.col("drop"))
    left = F.array_join(F.transform(places, lambda i: F.col("lines")[i]), "\n")
    return out.select("doc", F.when(F.col("drop").isNull(), text).otherwise(left).alias("text"),
                      n.cast("long").alias("n_lines"),
                      F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"))


def op11(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of every document."""
    return cleaned(docs).select("doc.doc_id", "n_lines", "n_dropped",
                                F.sha2(F.col("text"), 256).alias("kept_sha256"))


ORACLE_SQL = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (
  SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                      '{UPPER}', '{LOWER}') AS key FROM l),
c AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= {MIN_LENGTH}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS})
SELECT k.doc_id, CAST(count(*) AS BIGINT) AS n_lines,
       CAST(count(*) FILTER (WHERE c.keeper <> k.doc_id) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i)
                       FILTER (WHERE c.keeper IS NULL OR c.keeper = k.doc_id), '')) AS kept_sha256
FROM k LEFT JOIN c USING (key) GROUP BY k.doc_id
"""
