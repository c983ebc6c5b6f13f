"""Cell tables in Spark's catalog, for readers who write SQL.

``create_cell_table`` makes a Parquet table of delta rows, partitioned by batch and
bucketed by cell and member, and a view ``<name>_cells`` that folds it by the laws of its
families: ``SELECT * FROM <name>_cells`` gives what ``CellStore.scan`` gives.

``member`` holds the text of a UNION row and is null elsewhere, so one grouping by
``(row_key, family, qualifier, member)`` folds every law.  The buckets are dealt by these
four columns: a fold needs no exchange, and the members of a large UNION cell lie
in all buckets.  Laws are SUM, UNION and LAST; a SKETCH family is refused.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from usagelake.streaming.cells import LAST, SUM, UNION, as_deltas

CELL_KEYS = ["row_key", "family", "qualifier", "member"]
BUCKETS = 64


def _quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _literals(texts: list[str]) -> str:
    for t in texts:
        if "'" in t or "\\" in t:
            raise ValueError(f"a family name may not hold quotes or backslashes: {t}")
    return ", ".join(f"'{t}'" for t in texts)


def _families(spark: SparkSession, name: str) -> dict:
    """``{family: law}`` of a cell table, from its properties."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {_quoted(name)}").collect()
    return {r["key"].removeprefix("cell.law."): r["value"] for r in rows if r["key"].startswith("cell.law.")}


def _view_sql(name: str, families: dict) -> str:
    value = {SUM: "CAST(sum(num) AS STRING)", UNION: "member",
             LAST: "max_by(coalesce(text, CAST(num AS STRING)), struct(batch_id, seq))"}
    of_law = {law: _literals([f for f, have in families.items() if have == law]) for law in value}
    laws = " ".join(f"WHEN family IN ({fs}) THEN '{law}'" for law, fs in of_law.items() if fs)
    values = " ".join(f"WHEN family IN ({fs}) THEN {value[law]}" for law, fs in of_law.items() if fs)
    return (f"SELECT row_key, family, qualifier, CASE {laws} END AS law, CASE {values} END AS value "
            f"FROM {_quoted(name)} WHERE family IN ({_literals(list(families))}) GROUP BY {', '.join(CELL_KEYS)}")


def create_cell_table(spark: SparkSession, name: str, families: dict, location: str | None = None,
                      buckets: int = BUCKETS) -> bool:
    """Create the table ``name`` with ``{family: law}`` and its view ``<name>_cells``; False if it exists.

    Without ``location`` the warehouse holds the rows and a drop removes them; with one
    they stay, and a table created there again finds its batches.
    """
    if not families or set(families.values()) - {SUM, UNION, LAST}:
        raise ValueError("families need one of the laws SUM, UNION and LAST each")
    view = _view_sql(name, families)  # refuses bad family names before anything is made
    if spark.catalog.tableExists(name):
        return False
    laws = ", ".join(f"'cell.law.{f}' = '{law}'" for f, law in families.items())
    where = f" LOCATION '{location}'" if location else ""
    keys = ", ".join(CELL_KEYS)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_quoted(name)} (row_key STRING, family STRING, qualifier STRING, member STRING, "
        f"num BIGINT, text STRING, seq BIGINT, batch_id BIGINT) USING parquet PARTITIONED BY (batch_id) "
        f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {int(buckets)} BUCKETS{where} TBLPROPERTIES ({laws})")
    if location:
        folder = spark._jvm.org.apache.hadoop.fs.Path(location)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
        spark.catalog.recoverPartitions(_quoted(name))
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(name + '_cells')} AS {view}")
    return True


def drop_cell_table(spark: SparkSession, name: str) -> bool:
    """Drop a cell table and its view; False if absent."""
    found = spark.catalog.tableExists(name)
    spark.sql(f"DROP VIEW IF EXISTS {_quoted(name + '_cells')}")
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")
    return found


def add_cell_batch(spark: SparkSession, name: str, deltas: DataFrame, batch_id: int) -> None:
    """Write one batch of ``add`` deltas (columns as in ``cells``); a batch written again replaces its rows.

    A batch's rows are folded first, also map-side, so a cell has one row a batch (a
    UNION cell one a member) and each bucket one file; of LAST rows with one ``seq``
    the greatest text wins.  A row of an undeclared family fails the write, and none
    of the batch is left.  While a batch is replaced, readers may miss it.
    """
    families = _families(spark, name)
    buckets = next(int(r["data_type"]) for r in spark.sql(f"DESCRIBE EXTENDED {_quoted(name)}").collect()
                   if r["col_name"] == "Num Buckets")
    rows = as_deltas(deltas)
    known = F.col("family").isin(list(families)) & (F.col("op") == "add")
    refused = F.raise_error(F.concat_ws(" ", F.lit("not an addition to a declared family:"), "op", "family"))
    rows = rows.withColumn("family", F.when(known, F.col("family")).otherwise(refused))
    is_union = F.col("family").isin([f for f, law in families.items() if law == UNION])
    keyed = rows.select("row_key", "family", "qualifier", F.when(is_union, F.col("text")).alias("member"), "num",
                        F.when(~is_union, F.col("text")).alias("text"), "seq").where(~is_union | F.col("member").isNotNull())
    is_sum = F.col("family").isin([f for f, law in families.items() if law == SUM])
    last = F.max(F.struct("seq", "text", "num"))
    folded = keyed.groupBy(*CELL_KEYS).agg(F.sum("num").alias("_sum"), last.alias("_last")).select(
        *CELL_KEYS, F.when(is_sum, F.col("_sum")).otherwise(F.col("_last.num")).alias("num"),
        F.col("_last.text").alias("text"), F.col("_last.seq").alias("seq")).repartition(buckets, *CELL_KEYS)
    batch = f"cell_batch_{uuid.uuid4().hex}"
    folded.createOrReplaceTempView(batch)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {_quoted(name)} PARTITION (batch_id = {int(batch_id)}) SELECT * FROM {batch}")
    finally:
        spark.catalog.dropTempView(batch)
