"""Prefix trie of conversations with subtree totals by time-forward processing.

A node is a distinct sequence of first turns, named by a 128-bit chained hash.  Totals go
from children to parents: nodes are sorted by reverse level order, and a node sends its
totals forward to its parent, which comes later in that order, through a priority queue
addressed by place in the order.

The trie is cut into shards by the number of conversations through a node.  Band 0 are the
nodes with at most ``SHARD`` conversations, band 1 those with at most ``SHARD`` squared, and
so on; a shard is a connected piece of one band, named by its top node.  Along a path the
number never rises, so every band is met once, and a shard has at most ``SHARD`` nodes on a
level, however common its top is.  Shards of a band are swept side by side; the totals of
their tops are summed by parent and enter the next band.  There are log(conversations) /
log(``SHARD``) bands.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from xxhash import xxh3_128_digest

from usagelake.llm.common import arrow_limits, by_weight, drop_staged, staged

SHARD = 4096
BANDS = 5  # SHARD to this power passes any number of conversations
QUEUE = 1 << 16
IDS_PER_CHUNK = 2048
NODE = ["h1", "h2"]
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
_ROOT = bytes(16)
_CHAIN = "c long, depth long, h1 long, h2 long, p1 long, p2 long, len long, last boolean"
_TOTALS = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
           "saved_tokens long, h1 long, h2 long, p1 long, p2 long, up boolean")


class MessageQueue:
    """Priority queue of messages (address ..., payload ...), smallest address first.

    At most about ``limit`` messages are held as objects.  Beyond that the larger half goes
    to a sorted run of packed longs, of which only the first unread message is in the heap.
    """

    def __init__(self, limit: int = QUEUE):
        self.limit = limit
        self.heap: list[tuple] = []  # (message, run it came from or -1)
        self.runs: list[tuple[np.ndarray, int]] = []

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, (message, -1))
        if len(self.heap) > self.limit + len(self.runs):
            own = sorted(m for m, run in self.heap if run < 0)
            heads = [x for x in self.heap if x[1] >= 0]
            half = len(own) // 2
            self.runs.append((np.array(own[half:], np.int64), 0))
            self.heap = [(m, -1) for m in own[:half]] + heads
            heapq.heapify(self.heap)
            self._next(len(self.runs) - 1)

    def _next(self, run: int) -> None:
        rows, at = self.runs[run]
        if at < len(rows):
            heapq.heappush(self.heap, (tuple(rows[at].tolist()), run))
            self.runs[run] = rows, at + 1
        else:
            self.runs[run] = rows[:0], 0

    def take(self, address: tuple) -> Iterator[tuple]:
        """Remove and give the messages to ``address``, which must be the smallest one."""
        n = len(address)
        while self.heap and self.heap[0][0][:n] == address:
            message, run = heapq.heappop(self.heap)
            if run >= 0:
                self._next(run)
            yield message

    def __len__(self) -> int:
        return len(self.heap) + sum(len(rows) - at for rows, at in self.runs)


def turns(conversations: DataFrame) -> DataFrame:
    """Numbered turns -> ``c`` (conv_id), ``pos`` (from 0), ``t1, t2`` (128-bit hash of role and text), ``len``.

    Turns go by ``turn`` (null first), equal ones by role and text; rows without a conv_id belong
    to no conversation.  Null roles and texts are empty.
    """
    own = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("c"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("c").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return own.select("c", (F.row_number().over(order) - 1).cast("long").alias("pos"),
                      F.xxhash64("role", "text").alias("t1"), F.xxhash64(F.lit(1), "role", "text").alias("t2"),
                      F.length("text").cast("long").alias("len"))


def rebuilt(own: DataFrame) -> DataFrame:
    """Turns of rebuilt conversations, and for each one a row with ``pos`` -1.

    Conversation c is the first h turns of conversation ``c - c mod 100`` (floor), then its own
    turns after its first h; h is crc32 of c's digits modulo 6.  ``own`` is a written table of ``turns``.
    """
    h = F.pmod(F.crc32(F.col("c").cast("string").cast("binary")), F.lit(6))
    convs = own.where("pos = 0").select("c", h.alias("h"), (F.col("c") - F.pmod("c", F.lit(100))).alias("base"))
    first = own.where("pos < 5").withColumnRenamed("c", "base")
    return (own.where(F.col("pos") >= h)
            .unionByName(convs.join(first, "base").where("pos < h").drop("base", "h"))
            .unionByName(convs.select("c", F.lit(-1).cast("long").alias("pos")), allowMissingColumns=True))


def whole(own: DataFrame) -> DataFrame:
    """Turns of the conversations as they are, and for each one a row with ``pos`` -1."""
    return own.unionByName(own.where("pos = 0").select("c", F.lit(-1).cast("long").alias("pos")), allowMissingColumns=True)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Node and parent of every turn; rows come sorted by conversation and place."""
    held, node, depth = None, _ROOT, 0
    names = [f.split()[0] for f in _CHAIN.split(", ")][:-1]
    for b in batches:
        n = b.num_rows
        if n == 0:
            continue
        turn = np.stack([b.column(i).fill_null(0).to_numpy(zero_copy_only=False) for i in (2, 3)], 1).tobytes()
        begin = (b.column(1).to_numpy() < 0).tolist()
        nodes, parents, depths = [], [], []
        for i in range(n):
            parents.append(node)
            if begin[i]:
                node, depth = _ROOT, 0
                parents[-1] = _ROOT
            else:
                node, depth = xxh3_128_digest(node + turn[16 * i:16 * i + 16]), depth + 1
            nodes.append(node)
            depths.append(depth)
        at, up = (np.frombuffer(b"".join(x), np.int64).reshape(-1, 2) for x in (nodes, parents))
        cols = [b.column(0), pa.array(depths, pa.int64()), *(pa.array(x[:, k].copy()) for x in (at, up) for k in (0, 1)),
                b.column(4).fill_null(0)]
        t = pa.Table.from_arrays(cols, names)
        if held is not None:
            t = pa.concat_tables([held, t]).combine_chunks()
        c = t.column(0).to_numpy()
        done = t.slice(0, t.num_rows - 1).append_column("last", pa.array(c[1:] != c[:-1]))
        held = t.slice(t.num_rows - 1)
        yield from done.to_batches()
    if held is not None:
        yield from held.append_column("last", pa.array([True])).combine_chunks().to_batches()


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Subtree totals of shards; nodes come by shard, in reverse level order within it."""
    queue = MessageQueue()
    for b in batches:
        out = []
        for conv, depth, parent_conv, n_convs, length, h1, h2, p1, p2, s1, s2, kids, leaves, saved in zip(
                *(col.to_pylist() for col in b.columns)):
            saved += (n_convs - 1) * length
            for *_, more_leaves, more_saved in queue.take((-depth, h1, h2)):
                kids += 1
                leaves += more_leaves
                saved += more_saved
            leaves = leaves if kids else 1
            top = h1 == s1 and h2 == s2
            if not top:
                queue.push((1 - depth, p1, p2, leaves, saved))
            out.append((conv, depth, parent_conv, n_convs, kids, leaves, saved, h1, h2, p1, p2, top))
        if out:
            kinds = [pa.int64()] * 11 + [pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)],
                                             [f.split()[0] for f in _TOTALS.split(", ")])


def _ends(rows: DataFrame) -> DataFrame:
    """``h1, h2, ends_sha256`` of nodes at which conversations end.

    Ids are sorted over all partitions and joined to texts of a bounded number of ids; the texts
    of a node are then read in order, as a stream.
    """

    def joined(batches):
        for b in batches:
            h1, h2, c = (col.to_numpy() for col in b.columns)
            new = np.flatnonzero((np.diff(h1) != 0) | (np.diff(h2) != 0)) + 1
            cut = sorted({0, b.num_rows, *new.tolist(), *range(0, b.num_rows, IDS_PER_CHUNK)})
            ids = c.tolist()
            at = cut[:-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h1[at]), pa.array(h2[at]), pa.array(c[at]),
                 pa.array([",".join(map(str, ids[i:j])) for i, j in zip(at, cut[1:])], pa.string())],
                ["h1", "h2", "c", "ids"])

    def digests(batches):
        node, sha = None, None
        for b in batches:
            out = []
            for h1, h2, _, ids in zip(*(col.to_pylist() for col in b.columns)):
                if (h1, h2) == node:
                    sha.update(b"," + ids.encode())
                else:
                    if node is not None:
                        out.append((*node, sha.hexdigest()))
                    node, sha = (h1, h2), hashlib.sha256(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["h1", "h2", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, sha.hexdigest())], ["h1", "h2", "ends_sha256"])

    ends = rows.where("last").select(*NODE, "c").repartitionByRange(*NODE, "c").sortWithinPartitions(*NODE, "c")
    parts = ends.mapInArrow(joined, "h1 long, h2 long, c long, ids string")
    return parts.repartition(*NODE).sortWithinPartitions(*NODE, "c").mapInArrow(
        digests, "h1 long, h2 long, ends_sha256 string")


def _placed(rows: DataFrame, nodes: DataFrame, shard: int) -> DataFrame:
    """One row a node, with its parent's conversation, its band and the top of its shard."""
    # the root is in every conversation, a common first turn in many
    known = by_weight(rows.drop("last"), nodes, NODE, "n_convs", rows.count())
    band = sum((F.when(F.col("n_convs") > F.lit(shard ** i), 1).otherwise(0) for i in range(2, BANDS)),
               F.when(F.col("n_convs") > F.lit(shard), 1).otherwise(0))
    path = Window.partitionBy("c").orderBy("depth")
    top = Window.partitionBy("c", "band").orderBy("depth")
    x = known.withColumn("band", band).withColumn("parent_conv_id", F.lag("conv_id").over(path))
    x = x.withColumn("s1", F.first("h1").over(top)).withColumn("s2", F.first("h2").over(top))
    return x.where(F.col("c") == F.col("conv_id")).drop("c")


def prefix_trie(sequences: DataFrame, shard: int = SHARD) -> DataFrame:
    """Every node of the trie of ``sequences`` (``c, pos, t1, t2, len``, as ``whole`` or ``rebuilt`` give them).

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``
    (members), ``n_children``, ``n_leaves`` (childless nodes of the subtree), ``saved_tokens`` (over the
    subtree, (members - 1) times the length of a node's last turn) and ``ends_sha256`` (of the ids of
    the members that end at the node).  The text of a node is turn ``depth`` of ``conv_id``.
    Conversations without turns are members of the root; no conversations give no rows.  A
    conversation is read as a sorted stream, so its length has no bound.
    """
    arrow_limits(sequences.sparkSession)
    rows = staged(sequences.repartition("c").sortWithinPartitions("c", "pos").mapInArrow(_chain, _CHAIN), "trie-rows")
    nodes = staged(rows.groupBy(*NODE).agg(F.min("c").alias("conv_id"), F.count("*").alias("n_convs")), "trie-nodes")
    placed = staged(_placed(rows, nodes, shard), "trie-placed")
    ends = staged(_ends(rows), "trie-ends")
    drop_staged(rows)
    drop_staged(nodes)
    kinds = ["n_children", "n_leaves", "saved_tokens"]
    done = []
    for band in range((placed.agg(F.max("band")).first()[0] or 0) + 1):
        part = placed.where(F.col("band") == band)
        if done:
            up = done[0]
            for d in done[1:]:
                up = up.unionByName(d)
            up = up.where("up and depth > 0").groupBy(F.col("p1").alias("h1"), F.col("p2").alias("h2")).agg(
                F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
            part = part.join(up, NODE, "left").na.fill(0, kinds)
        else:
            part = part.select("*", *[F.lit(0).cast("long").alias(k) for k in kinds])
        part = part.select("conv_id", "depth", "parent_conv_id", "n_convs", "len", *NODE, "p1", "p2", "s1", "s2", *kinds)
        part = part.repartition("s1", "s2").sortWithinPartitions("s1", "s2", F.desc("depth"), *NODE)
        done.append(staged(part.mapInArrow(_sweep, _TOTALS), f"trie-band{band}"))
    drop_staged(placed)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.join(ends, NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"))


def op13(conversations: DataFrame) -> DataFrame:
    own = staged(turns(conversations), "turns")
    out = prefix_trie(rebuilt(own))
    drop_staged(own)
    return out


ORACLE_SQL = """
WITH o AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS t,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
k AS (
  SELECT c, c - c % 100 AS base,
         xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
             lambda x, y: list_reduce(list_concat([xor(x, y)], range(8)), lambda u, v: xor(u >> 1, (u & 1) * 3988292384))),
             4294967295::BIGINT) % 6 AS h
  FROM (SELECT DISTINCT c FROM o)),
m AS (
  SELECT k.c, o.pos, o.r, o.t FROM k JOIN o ON o.c = k.base WHERE o.pos < k.h UNION ALL
  SELECT k.c, o.pos, o.r, o.t FROM k JOIN o ON o.c = k.c WHERE o.pos >= k.h),
s AS (
  SELECT c, row_number() OVER w AS d, length(t) AS len,
         string_agg(md5(concat(md5(r), md5(t))), '') OVER w AS path FROM m WINDOW w AS (PARTITION BY c ORDER BY pos)
  UNION ALL SELECT c, 0, 0, '' FROM k),
n AS (SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, any_value(len) AS len FROM s GROUP BY path, d),
e AS (
  SELECT path, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids
  FROM (SELECT c, arg_max(path, d) AS path FROM s GROUP BY c) GROUP BY path),
kids AS (SELECT left(path, 32 * (d - 1)) AS path, count(*) AS n FROM n WHERE d > 0 GROUP BY ALL),
a AS (
  SELECT left(n.path, 32 * x) AS path, n.n_convs, n.len, kids.n IS NULL AS leaf
  FROM (SELECT *, unnest(range(0, d + 1)) AS x FROM n) AS n LEFT JOIN kids ON kids.path = n.path),
sums AS (SELECT path, count(*) FILTER (WHERE leaf) AS n_leaves, sum((n_convs - 1) * len) AS saved FROM a GROUP BY path)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs,
       CAST(coalesce(kids.n, 0) AS BIGINT) AS n_children, CAST(sums.n_leaves AS BIGINT) AS n_leaves,
       CAST(sums.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM n LEFT JOIN n AS p ON n.d > 0 AND p.path = left(n.path, 32 * (n.d - 1)) LEFT JOIN kids ON kids.path = n.path
  LEFT JOIN e ON e.path = n.path JOIN sums ON sums.path = n.path
"""
