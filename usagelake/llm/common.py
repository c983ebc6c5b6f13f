"""Helpers shared by the operators: table access, written stages, Arrow text access."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from usagelake.session import shared_dir

# Rows of long texts must not pile up in one Arrow batch: batches are cut by
# bytes, and the numpy work inside a task runs on slices of CHUNK_BYTES (one
# document more than that is a slice of its own).
ARROW_BATCH_BYTES = "4m"
ARROW_BATCH_ROWS = "2000"
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Runs of bytes other than ASCII white space in a text; null for null.

    ``regexp_count`` makes a list of all words of the text to count them; here every word with
    the white space after it becomes one letter.
    """
    rest = F.ltrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.length(F.regexp_replace(rest, r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", "w"))


def arrow_limits(spark: SparkSession) -> None:
    """Bound the Arrow batches that tasks hand to Python, by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH_BYTES)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the cluster's shared folder and read it back.

    Cuts the lineage: a lost executor re-reads the files.  Every call has a
    folder of its own, so concurrent runs cannot meet.
    """
    spark = df.sparkSession
    path = shared_dir(spark, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Remove one of this subpackage's folders in the shared folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if path.getName().startswith("llm-"):
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_staged(df: DataFrame) -> None:
    """Remove the files of a staged table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        delete_folder(spark, folder)


def by_weight(left: DataFrame, right: DataFrame, keys: list[str], weight: str, total: int, how: str = "inner",
              heavy: int = 1000) -> DataFrame:
    """``left`` joined with ``right`` (one row a key) although some keys hold much of ``left``.

    ``weight`` is a column of ``right``: how many of the ``total`` rows of ``left`` have the
    key.  Keys with more than one of ``heavy`` parts of all rows, which are fewer than
    ``heavy``, are broadcast; the rows of the others are shuffled.  ``how``: inner or left.
    """
    big = F.col(weight) * heavy > F.lit(total)
    few, many = right.where(big), right.where(~big)
    rest = left.join(F.broadcast(few.select(*keys)), keys, "left_anti")
    return left.join(F.broadcast(few), keys).unionByName(rest.join(many, keys, how))


def merged(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """Batches put together up to about ``limit`` bytes."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= limit:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string column; null texts count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def slices(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each; a longer row stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
