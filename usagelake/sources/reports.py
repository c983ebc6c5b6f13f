"""Report documents: strict JSON decode, encode, and line sources.

A report is one JSON object per line::

    {"user_id": .., "province": .., "city": .., "date": .., "apps": [
       {"package_name": .., "beginTime": <ms>, "endTime": <ms>, "version": .., "kind": ..}, ..],
     "brand": .., "model": .., "language": .., "system_version": ..,
     "resolution": .., "net_status": .., "ISP": ..}

Decoding is strict: every field must be present with its JSON type (strings
as strings, times as whole numbers, also written as ``1.0``); extra fields are
ignored.  Each line gets a status: 1 accepted, 0 well-formed JSON that does not
conform (dropped), -1 malformed text (kept for quarantine instead of failing
the job).  An object that names a field twice is malformed text here.  All
checks are Variant expressions evaluated in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Wire names of the report and session fields, in document order.
REPORT_STRING_FIELDS = ("user_id", "province", "city", "date", "brand", "model", "language",
                        "system_version", "resolution", "net_status", "ISP")
WIRE_ORDER = ("user_id", "province", "city", "date", "apps", "brand", "model", "language",
              "system_version", "resolution", "net_status", "ISP")
APP_STRING_FIELDS = ("package_name", "version", "kind")
APP_LONG_FIELDS = ("beginTime", "endTime")

APPS_TYPE = ("array<struct<package_name:string,beginTime:bigint,endTime:bigint,"
             "version:string,kind:string>>")


def _kind_sql(v: str, path: str) -> str:
    return f"coalesce(schema_of_variant(try_variant_get({v}, '{path}', 'variant')), '')"


def _whole_sql(v: str, path: str) -> str:
    """A fractional JSON number without a fraction, within the range of a bigint."""
    kind = _kind_sql(v, path)
    number = f"try_variant_get({v}, '{path}', 'double')"
    return (f"(({kind} LIKE 'DECIMAL%' OR {kind} = 'DOUBLE') AND "
            f"coalesce({number} = try_variant_get({v}, '{path}', 'bigint'), false))")


def decode_status_sql(v: str) -> str:
    """SQL text of the status of a parsed Variant column ``v``.

    Built as one SQL expression so the JVM parses it in a single call.
    """
    top = [f"{_kind_sql(v, '$.' + f)} = 'STRING'" for f in REPORT_STRING_FIELDS]
    top.append(f"{_kind_sql(v, '$.apps')} LIKE 'ARRAY<%'")
    per_app = [f"{_kind_sql('a', '$.' + f)} = 'STRING'" for f in APP_STRING_FIELDS]
    per_app += [f"({_kind_sql('a', '$.' + f)} = 'BIGINT' OR {_whole_sql('a', '$.' + f)})" for f in APP_LONG_FIELDS]
    apps = (f"coalesce(forall(try_variant_get({v}, '$.apps', 'array<variant>'), "
            f"a -> {' AND '.join(per_app)}), false)")
    ok = " AND ".join(top + [apps])
    return f"CASE WHEN {v} IS NULL THEN -1 WHEN {ok} THEN 1 ELSE 0 END"


def decode_status(v: Column | str) -> Column:
    """1 / 0 / -1 for a parsed Variant column (NULL when the text did not parse)."""
    if isinstance(v, Column):
        raise TypeError("pass the Variant column by name")
    return F.expr(decode_status_sql(v))


def decode_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Every line with its ``status`` and, when accepted, the decoded report.

    -> ``status, value`` plus the report columns (NULL unless status = 1).
    """
    keep = [c for c in lines.columns if c != value_col]
    with_status = _with_status(lines, keep + [value_col], value_col)
    good = F.col("status") == 1
    fields = [F.when(good, F.variant_get("_v", f"$.{f}", "string")).alias(f.lower())
              for f in REPORT_STRING_FIELDS]
    apps = F.transform(F.variant_get("_v", "$.apps", APPS_TYPE), lambda a: F.struct(
        a["package_name"].alias("package_name"), a["beginTime"].alias("begin_time"),
        a["endTime"].alias("end_time"), a["version"].alias("version"), a["kind"].alias("kind")))
    return with_status.select(*keep, value_col, "status", *fields, F.when(good, apps).alias("apps"))


def _with_status(lines: DataFrame, columns: list[str], value_col: str) -> DataFrame:
    """``columns`` with the parsed Variant ``_v`` and its ``status``, each computed once per line.

    Both pass through ``explode`` of a one-element array: filters and later
    expressions read the result instead of repeating the parse.
    """
    parsed = lines.select(*columns, F.explode(F.array(F.try_parse_json(F.col(value_col)))).alias("_v"))
    return parsed.select("*", F.explode(F.array(decode_status("_v"))).alias("status"))


def arrival(lines: DataFrame) -> Column:
    """Arrival order of lines: file time, path and block, then the place in the block.

    ``lines`` from ``read_report_lines`` carry the file part; other lines are
    ordered by their place in the input (partition, then row).
    """
    place = F.monotonically_increasing_id().alias("place")
    if "arrival" in lines.columns:
        return F.struct("arrival.file_time", "arrival.file_path", "arrival.block_start", place)
    return F.struct(place)


def reports_decode(lines: DataFrame, value_col: str = "value",
                   report_id: Column | None = None, ingest_seq: Column | None = None) -> DataFrame:
    """Accepted reports only (status 1).

    ``ingest_seq`` orders reports for last-write metrics; by default it is
    the lines' ``arrival`` order.  ``report_id`` defaults to the text of that
    order.
    """
    d = decode_lines(lines.withColumn("_seq", ingest_seq if ingest_seq is not None else arrival(lines)), value_col)
    d = d.filter(F.col("status") == 1).drop("ingest_seq").withColumnRenamed("_seq", "ingest_seq")
    rid = report_id if report_id is not None else F.col("ingest_seq").cast("string")
    return d.withColumn("report_id", rid).drop(value_col, "status", "arrival", "source_file")


STATUS_METRIC = "report_status"


def status_metrics(status: str = "status") -> list[Column]:
    """Aggregates for ``observe``: lines accepted, non-conforming (dropped) and malformed."""
    s = F.col(status)
    return [F.count_if(s == 1).alias("accepted"), F.count_if(s == 0).alias("nonconforming"),
            F.count_if(s == -1).alias("malformed")]


def decode_status_counts(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Lines per status -> ``status, lines``."""
    return _with_status(lines, [], value_col).groupBy("status").agg(F.count("*").alias("lines"))


def reports_encode(reports: DataFrame, keep=("report_id",)) -> DataFrame:
    """Nested reports -> one JSON text per report (``value`` plus the ``keep`` columns)."""
    apps = F.transform("apps", lambda a: F.struct(
        a["package_name"].alias("package_name"), a["begin_time"].alias("beginTime"),
        a["end_time"].alias("endTime"), a["version"].alias("version"), a["kind"].alias("kind")))
    fields = [apps.alias("apps") if f == "apps" else F.col(f.lower()).alias(f) for f in WIRE_ORDER]
    kept = [c for c in keep if c in reports.columns]
    return reports.select(*kept, F.to_json(F.struct(*fields)).alias("value"))


# ---- line sources -------------------------------------------------------

def read_report_lines(spark: SparkSession, path: str, stream: bool = False,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Newline-delimited report text from files (batch or Structured Streaming).

    -> ``value``, ``source_file`` and ``arrival`` (file time, path, block start), which
    orders lines whatever way Spark packs files into partitions.
    """
    if stream:
        r = spark.readStream.format("text")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
        df = r.load(path)
    else:
        df = spark.read.text(path)
    m = F.col("_metadata")
    return df.select("*", m["file_path"].alias("source_file"), F.struct(
        m["file_modification_time"].alias("file_time"), m["file_path"].alias("file_path"),
        m["file_block_start"].alias("block_start")).alias("arrival"))


def read_report_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Socket text stream (development only: the socket source is not replayable)."""
    return spark.readStream.format("socket").option("host", host).option("port", str(port)).load()


def kafka_options(bootstrap_servers: str, topics, starting_offsets: str = "latest",
                  **extra: str) -> dict:
    """Options for ``readStream.format("kafka")``: topic set, start at latest.

    Offsets are tracked by the query checkpoint, never auto-committed.
    """
    topics = topics if isinstance(topics, str) else ",".join(topics)
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topics,
            "startingOffsets": starting_offsets}
    opts.update(extra)
    return opts


def read_report_kafka(spark: SparkSession, **options: str) -> DataFrame:
    """Kafka records as text -> ``value, ingest_seq parts``.

    Needs the Kafka connector on the classpath.  ``timestamp, partition,
    offset`` are kept so a caller can derive an ingest order.
    """
    df = spark.readStream.format("kafka").options(**options).load()
    return df.select(F.col("value").cast("string").alias("value"), "timestamp", "partition", "offset")


def print_batch(df: DataFrame, n: int = 10) -> None:
    """Show the first rows of a (batch) DataFrame, as a console sink would."""
    df.show(n, truncate=False)


def console_sink(df: DataFrame, n: int = 10):
    """Console sink for a streaming DataFrame (prints the head of each batch)."""
    return df.writeStream.format("console").option("numRows", str(n)).option("truncate", "false")


# ---- dimension scans -----------------------------------------------------

def jdbc_dim_scan(spark: SparkSession, url: str, table: str, properties: dict | None = None,
                  partition_column: str | None = None, lower: int | None = None,
                  upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Full scan of one dimension table over JDBC.

    Credentials come from ``properties`` (never literals in code).  Give a
    numeric ``partition_column`` with bounds to read in parallel.
    """
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower))
             .option("upperBound", str(upper)).option("numPartitions", str(num_partitions or 8)))
    return r.load()


def range_scan(spark: SparkSession, n: int, num_partitions: int | None = None) -> DataFrame:
    """Distributed longs ``1..n`` -> ``id``."""
    return spark.range(1, n + 1, numPartitions=num_partitions)
