"""Sort an occurrence table by key and compare neighbours, at any size and skew.

Occurrences ``key, doc_id, pos`` are range-partitioned by (key, doc_id), so a key
with a large share of all rows is spread over many tasks, and sorted in each
task.  What a task can't know, because a run of one key goes on in the next
partition, is added from a table with a few rows per partition.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from usagelake.llm.common import arrow_limits, staged

ROWS_PER_PARTITION = 500_000
_COLUMNS = ("key", "doc_id", "pos", "first_doc", "first_pos", "prev_doc", "prev_pos")
_SCHEMA = ", ".join(f"{c} long" for c in _COLUMNS) + ", many boolean, edge boolean, part int, last boolean"


def _compare(key, doc, pos, part: int, by_rank: bool) -> pa.RecordBatch:
    """Runs of equal keys in one sorted partition: rows of runs of several documents, and of its ends."""
    order = np.lexsort((pos, doc, key))
    key, doc, pos = key[order], doc[order], pos[order]
    n = len(key)
    index = np.arange(n)
    new_key = np.ones(n, bool)
    new_key[1:] = key[1:] != key[:-1]
    new_doc = new_key.copy()
    new_doc[1:] |= doc[1:] != doc[:-1]
    start = np.maximum.accumulate(np.where(new_key, index, 0))
    end = np.append(np.flatnonzero(new_key)[1:], n)[np.cumsum(new_key) - 1] - 1
    many = doc[start] != doc[end]
    edge = (key == key[0]) | (key == key[-1])
    before = np.maximum.accumulate(np.where(new_doc, index, 0)) - 1  # last row of the document before
    has_prev = before >= start
    before = np.maximum(before, 0)
    first = start
    if by_rank:  # the n-th occurrence in a document goes with the n-th in the other, or its last
        own = np.maximum.accumulate(np.where(new_doc, index, 0))
        stop = np.append(np.flatnonzero(new_doc)[1:], n)[np.cumsum(new_doc) - 1] - 1
        rank = index - own
        first = np.minimum(start + rank, stop[start])
        before = np.minimum(own[before] + rank, before)
    keep = many | edge
    none = ~has_prev[keep]
    last = (index == n - 1)[keep]
    cols = [pa.array(c[keep]) for c in (key, doc, pos, doc[first], pos[first])]
    cols += [pa.array(c[before][keep], mask=none) for c in (doc, pos)]
    cols += [pa.array(many[keep]), pa.array(edge[keep]), pa.array(np.full(int(keep.sum()), part, np.int32)),
             pa.array(last)]
    return pa.RecordBatch.from_arrays(cols, [*_COLUMNS, "many", "edge", "part", "last"])


def neighbours(occurrences: DataFrame, name: str, by_rank: bool = False) -> DataFrame:
    """Rows whose key occurs in several documents, with the key's first occurrence
    (``first_doc, first_pos``) and the last one of the document before (``prev_doc, prev_pos``, null for the
    first document).  ``by_rank`` takes the n-th occurrence of the other document for a
    document's n-th (the last if it has fewer; the key's first one and the document before's
    last one across the end of a partition).  ``occurrences`` must be a written table without nulls.
    """
    spark = occurrences.sparkSession
    arrow_limits(spark)
    n = occurrences.count()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // ROWS_PER_PARTITION))

    def run(batches):
        got = [[b.column(i).to_numpy(zero_copy_only=False) for i in range(3)] for b in batches if b.num_rows]
        if got:
            whole = _compare(*(np.concatenate(c) for c in zip(*got)), TaskContext.get().partitionId(), by_rank)
            for i in range(0, whole.num_rows, 1 << 17):
                yield whole.slice(i, 1 << 17)

    runs = staged(occurrences.select("key", "doc_id", "pos").repartitionByRange(parts, "key", "doc_id")
                  .mapInArrow(run, _SCHEMA), name)
    # at most two keys and one last row for each partition: two small tables, bounded by the partitions
    ends = runs.where("edge").groupBy("key").agg(
        F.min(F.struct("first_doc", "first_pos")).alias("f"), (F.min("doc_id") != F.max("doc_id")).alias("m")).orderBy("key")
    heads = np.array([(r["key"], r["f"]["first_doc"], r["f"]["first_pos"], r["m"]) for r in ends.collect()],
                     np.int64).reshape(-1, 4)
    tails = np.array(sorted((r["part"], r["key"], r["doc_id"], r["pos"]) for r in
                            runs.where("last").select("part", "key", "doc_id", "pos").collect()), np.int64).reshape(-1, 4)
    shared = spark.sparkContext.broadcast((heads, tails))

    def resolve(batches):
        heads, tails = shared.value
        for b in batches:
            c = [b.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            prev = [pc.fill_null(b.column(i), 0).to_numpy(zero_copy_only=False).copy() for i in (5, 6)]
            none = b.column("prev_doc").is_null().to_numpy(zero_copy_only=False).copy()
            many = b.column("many").to_numpy(zero_copy_only=False).copy()
            edge = np.flatnonzero(b.column("edge").to_numpy(zero_copy_only=False))
            part = b.column("part").to_numpy(zero_copy_only=False)
            first = [x.copy() for x in c[3:]]
            if len(edge):
                head = heads[np.searchsorted(heads[:, 0], c[0][edge])]
                many[edge] = head[:, 3] != 0
                over = first[0][edge] != head[:, 1]  # the run began in a partition before
                first[0][edge[over]], first[1][edge[over]] = head[over, 1], head[over, 2]
            for p in np.unique(part[edge]).tolist():
                at = int(np.searchsorted(tails[:, 0], p)) - 1
                if at >= 0:  # rows of the partition's first document whose key the partition before ends with
                    _, key, doc, pos = tails[at]
                    rows = (part == p) & (c[0] == key) & none
                    prev[0][rows], prev[1][rows], none[rows] = doc, pos, False
            cols = [*(pa.array(x[many]) for x in (*c[:3], *first)), *(pa.array(x[many], mask=none[many]) for x in prev)]
            yield pa.RecordBatch.from_arrays(cols, list(_COLUMNS))

    return runs.mapInArrow(resolve, ", ".join(f"{c} long" for c in _COLUMNS))
