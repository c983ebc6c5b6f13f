"""SimHash near-dedup: fingerprints joined through a segment-popcount embedding.

A 64-bit fingerprint is mapped to the bit counts of its segments.  The
Manhattan distance of two such vectors never exceeds the Hamming distance of
the fingerprints, so it is a lower bound.  The grid: the vector is cut into
``2 * max_distance`` blocks; a pair within Manhattan distance ``d`` differs in at
most ``d`` blocks and agrees on the others, so it shares the grid cell of some
``d`` equal blocks.  Fingerprints of one cell are compared: Manhattan bound first,
then the exact Hamming distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh64_intdigest

from usagelake.llm.common import arrow_limits, fresh, staged, utf8
from usagelake.llm.components import components

SEED = 42
SEGMENT_BITS = 2
CELL_BLOCK = 2048


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of the word shingles of one UTF-8 text (A-Z lower-cased), as unsigned 64 bits."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(joined, SEED)
    cut = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=cut[1:])
    first, last = cut[:-shingle].tolist(), (cut[shingle:] - 1).tolist()
    n = len(first)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        h = np.array([xxh64_intdigest(joined[a:b], SEED)
                      for a, b in zip(first[i:i + (1 << 16)], last[i:i + (1 << 16)])], np.uint64)
        bits = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, row: str | None = None) -> DataFrame:
    """``doc_id, fp, row`` for every row of ``docs``: the fingerprint as a signed long, and the number in its
    column ``row`` (without one, a number of this read only)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, off = utf8(b.column(1))
            data = buf.tobytes()
            fp = np.array([fingerprint(data[i:j], shingle) for i, j in zip(off[:-1], off[1:])], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64)), b.column(2)],
                                             ["doc_id", "fp", "row"])

    arrow_limits(docs.sparkSession)
    number = F.col(row) if row else F.monotonically_increasing_id()
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                       number.alias("row")).mapInArrow(run, "doc_id long, fp long, row long")


def embedding(fp: np.ndarray, segment_bits: int = SEGMENT_BITS) -> np.ndarray:
    """Bit counts of the segments of each fingerprint: one int8 row per fingerprint."""
    bits = np.unpackbits(fp.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits.reshape(len(fp), 64 // segment_bits, segment_bits).sum(axis=2, dtype=np.int8)


def grid_cells(distinct: DataFrame, max_distance: int) -> DataFrame:
    """``band, cell, fp``: the grid cells of every fingerprint.

    A cell is the hash of the vector's entries in one choice of blocks, so equal
    entries always share it; unrelated entries that collide are refuted later.
    """
    blocks = np.array_split(np.arange(64 // SEGMENT_BITS), 2 * max_distance)
    choices = [np.concatenate([blocks[i] for i in c])
               for c in combinations(range(len(blocks)), max_distance)] if max_distance else [
                   np.arange(64 // SEGMENT_BITS)]
    rng = np.random.default_rng(SEED)
    factors = rng.integers(1, 1 << 63, 64 // SEGMENT_BITS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches):
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False)
            e = embedding(fp.view(np.uint64)).astype(np.uint64)
            for k, dims in enumerate(choices):
                cell = (e[:, dims] * factors[dims]).sum(axis=1, dtype=np.uint64)
                cell ^= cell >> np.uint64(32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(fp), k, np.int32)), pa.array(cell.view(np.int64)), pa.array(fp)],
                    ["band", "cell", "fp"])

    return distinct.select("fp").mapInArrow(run, "band int, cell long, fp long")


def _linked(fp: np.ndarray, max_distance: int) -> Iterator[tuple[int, int]]:
    """Star edges joining the fingerprints of one cell that are chained by links."""
    bits = fp.view(np.uint64)
    e = embedding(bits)
    left = np.arange(len(fp))
    while len(left) > 1:
        root, left = left[0], left[1:]
        group, front = [], [root]
        while front and len(left):
            at = front.pop()
            near = np.abs(e[left] - e[at]).sum(axis=1, dtype=np.int16) <= max_distance
            near[near] = np.bitwise_count(bits[left[near]] ^ bits[at]) <= max_distance
            found = left[near]
            if len(found):
                left = left[~near]
                front += found.tolist()
                group += found.tolist()
        for x in group:
            yield int(fp[root]), int(fp[x])


def grid_links(distinct: DataFrame, max_distance: int, cell_block: int = CELL_BLOCK) -> DataFrame:
    """Edges ``a, b`` whose closure equals that of all pairs within ``max_distance`` bits.

    A cell above ``cell_block`` fingerprints is cut into blocks, and every pair of
    blocks is a group of its own, so no task holds more than two blocks of a
    cell and no pair is lost.  A group returns a spanning forest, never all pairs.
    """
    cells = grid_cells(distinct, max_distance)
    sizes = cells.groupBy("band", "cell").count().where("count > 1")
    held = cells.join(sizes, ["band", "cell"])
    held = held.withColumn("blocks", F.ceil(F.col("count") / cell_block).cast("int"))
    held = held.withColumn("own", F.pmod(F.xxhash64("fp"), "blocks").cast("int"))
    held = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    held = held.where("blocks = 1 or own <> other").select(
        F.xxhash64("band", "cell", F.least("own", "other"), F.greatest("own", "other")).alias("g"), "fp")

    def run(batches):
        kept_g = np.zeros(0, np.int64)
        kept_fp = np.zeros(0, np.int64)

        def edges(g, fp):
            out = []
            cut = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1], [True])))
            for i, j in zip(cut[:-1], cut[1:]):
                if j - i > 1:
                    out += _linked(fp[i:j], max_distance)
            a = np.array(out, np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], ["a", "b"])

        for b in batches:
            g = np.concatenate((kept_g, b.column(0).to_numpy(zero_copy_only=False)))
            fp = np.concatenate((kept_fp, b.column(1).to_numpy(zero_copy_only=False)))
            if not len(g):
                continue
            k = int(np.searchsorted(g, g[-1]))
            if k:
                yield edges(g[:k], fp[:k])
            kept_g, kept_fp = g[k:], fp[k:]
        if len(kept_g):
            yield edges(kept_g, kept_fp)

    return held.repartition("g").sortWithinPartitions("g", "fp").mapInArrow(run, "a long, b long")


def simhash_classes(docs: DataFrame, shingle: int = 3, max_distance: int = 3, row: str | None = None) -> DataFrame:
    """``doc_id, fp, row, component_id`` for every row: the smallest doc_id reachable by links.

    Null and empty texts have fingerprint zero and link like any other; repeated
    rows share a fingerprint; a null doc_id keeps its row and counts last as a
    representative; an empty table gives no rows.  Extra columns are ignored.
    """
    fps = staged(fingerprints(docs, shingle, row), "simhash")
    heads = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("head")), "simhash-heads")
    links = components(grid_links(heads, max_distance))
    lead = links.join(heads, links["node"] == heads["fp"]).select("root", "node", "head")
    low = lead.groupBy("root").agg(F.min("head").alias("component_id"))
    linked = lead.join(low, "root").select(F.col("node").alias("fp"), "component_id")
    classes = heads.join(linked, "fp", "left").select(
        "fp", F.coalesce("component_id", "head").alias("component_id"))
    return fps.join(classes, "fp").select("doc_id", "fp", "row", "component_id")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of each class, that of the smallest doc_id (its first row if repeated), columns unchanged.

    The rows are numbered once and written with their numbers, so the fingerprints
    and the rows that stay are read from one table, however files are split later.
    """
    row = fresh(docs, "_row")
    numbered = staged(docs.withColumn(row, F.monotonically_increasing_id()), "simhash-docs")
    first = simhash_classes(numbered, row=row).groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("m"))
    return numbered.join(first.select(F.col("m.row").alias(row)), row, "left_semi").select(*docs.columns)


def op7(docs: DataFrame) -> DataFrame:
    """The contract's digest of :func:`simhash_classes`."""
    return simhash_classes(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
