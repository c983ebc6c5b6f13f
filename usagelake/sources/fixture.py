"""Deterministic usage fixture over the driver's TPC-H-ish tables.

One row per app session, derived from ``events`` joined with a user
dimension built from ``customer``, ``nation``, ``region`` and ``part``.  A
report is ``(user_id, date, event_id % 2)``, so many user-days have two
reports, which exercises the last-write metrics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from usagelake.functions.expressions import epoch_ms_of

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

SESSION_COLUMNS = (
    "report_id", "ingest_seq", "user_id", "province", "city", "date", "session_seq",
    "package_name", "begin_time", "end_time", "version", "kind", "brand", "model",
    "language", "system_version", "resolution", "net_status", "isp",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def user_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-user device and place attributes, keyed by ``uid`` (a bigint).

    Dimension-to-dimension joins on unique keys: no skew is possible here.
    ``nation`` and ``region`` are tiny and broadcast by the optimiser's size
    check; ``customer`` and ``part`` join on their primary keys.
    """
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    place = n.join(r, n.n_regionkey == r.r_regionkey)
    cust = c.join(place, c.c_nationkey == place.n_nationkey)
    dim = cust.join(p, cust.c_custkey == p.p_partkey)
    size_s = F.col("p_size").cast("string")
    return dim.select(
        F.col("c_custkey").alias("uid"),
        F.col("n_name").alias("province"),
        F.col("r_name").alias("city"),
        F.col("p_brand").alias("brand"),
        F.col("p_name").alias("model"),
        F.col("c_mktsegment").alias("language"),
        F.concat(F.lit("os"), (F.col("p_size") % 6).cast("string")).alias("system_version"),
        F.concat(size_s, F.lit("x"), (F.col("p_size") * 2).cast("string")).alias("resolution"),
    )


# Session columns that come from the user dimension.
DIMENSION_COLUMNS = ("province", "city", "brand", "model", "language", "system_version", "resolution")


def usage_sessions(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Long session rows with report attributes (see FIXTURES.md).

    ``columns`` names the columns wanted (default: all).  Without a column of
    the user dimension the events table is read alone: every event has its
    user, so the join would keep all rows.

    ``ingest_seq`` is the report's slot (``event_id % 2``): within a user-day
    the slot-1 report arrived after the slot-0 one.  It only orders reports of
    the same user-day, with ``report_id`` as the tie-break.
    """
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    begin = epoch_ms_of("ts")
    k = F.get_json_object("props", "$.k").cast("bigint")
    s = e.select(
        "event_id", "user_id",
        F.col("user_id").cast("string").alias("uid_s"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        (F.col("event_id") % 2).alias("slot"),
        begin.alias("begin_time"),
        (begin + F.round(F.col("value") * 100).cast("bigint") * 300).alias("end_time"),
        F.col("event_type").alias("kind"),
        k.alias("k"),
    )
    wanted = SESSION_COLUMNS if columns is None else columns
    # One equi-join of the fact table on user_id.  AQE turns it into a
    # broadcast when the dimension is small at run time and splits skewed
    # user partitions otherwise.
    j = s
    if set(wanted) & set(DIMENSION_COLUMNS):
        dim = user_dimension(spark, sf_dir)
        j = s.join(dim, s.user_id == dim.uid)
    # The app versions, in order.
    version = (F.when(F.col("k") % 5 == 0, "1.0").when(F.col("k") % 5 == 1, "1.1")
               .when(F.col("k") % 5 == 2, "2.0").when(F.col("k") % 5 == 3, "3.0").otherwise("4.0"))
    net = F.when(F.col("user_id") % 3 == 0, "wifi").when(F.col("user_id") % 3 == 1, "4g").otherwise("3g")
    made = {
        "report_id": F.concat_ws("-", "uid_s", "date", F.col("slot").cast("string")),
        "ingest_seq": F.col("slot"),
        "user_id": F.col("uid_s"),
        "session_seq": F.col("event_id"),
        "package_name": F.concat(F.lit("com."), F.col("kind"), F.lit(".a"), (F.col("k") % 8).cast("string")),
        "version": version,
        "net_status": net,
        "isp": F.concat(F.lit("isp"), (F.col("user_id") % 4).cast("string")),
    }
    return j.select(*[made.get(c, F.col(c)).alias(c) for c in SESSION_COLUMNS if c in wanted])
