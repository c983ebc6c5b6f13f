"""Substring dedup by collinear chaining: fuzzy passages that documents share.

Equal texts are one document, the smallest of their ids; the others are listed as its
copies.  Seeds are all runs of SEED_WORDS words.  50 words of which 10 were replaced keep
a run of 4 words at least wherever the 10 lie, and 7 seeds.  Most seeds occur in one
document only: slices of documents ask, with four packed bytes a seed, which of theirs
other slices have too, and only those become rows.  A seed of at most RARE documents
joins all of them with each other.  A passage whose shared seeds are all more frequent
lies where MIN_SEEDS frequent seeds do; there such a seed is joined together with one of the rarest
words near it, again in all documents that have both, however many they are (``_with_words``: any two
passages share such a word).  Only equal runs of MIN_WORDS words around the seed are not expanded into
all pairs: the documents with such a run are linked with the first one that has it, and with each
other by the seeds outside it.  The links of a pair of documents are
anchors; the best chains of anchors that rise in both documents, less a cost for the
gaps, are found with a Fenwick tree over the second document's places.  Chains go to their first
document and, with its words around them, on to the second one; there they are aligned word by
word, their ends extended, and kept where they are long and similar enough; of
other chains and the words around them, every part that is long and similar
enough is kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Observation, functions as F

from usagelake.llm.common import arrow_limits, by_weight, drop_staged, staged
from usagelake.llm.suffix_array import _documents, _out
from usagelake.llm.words import mix, window_hashes

SEED_WORDS = 4
BUCKET_BYTES = 1 << 22  # of text for each bucket of seeds
MIN_WORDS = 50
SIMILARITY = 0.8
RARE = 64  # documents of a seed that join all others without the words near them
FEW = 256  # occurrences of a frequent seed up to which all of different labels are joined, without words
LINKS = 1 << 27  # links, counted at most, of one pass over the document pairs
BUCKET_LINKS = 1 << 18
SHARE = 1 << 28  # words around chains that are aligned at once
SENT = 1 << 17  # words of a document that are sent in one row, or met by another document's in one
BLOCK = 4096  # rows of a key that meet in one task
PREFIX = round((1 - SIMILARITY) * MIN_WORDS) + 1  # of the rarest words of a window, one at least is shared
ORDER_BITS = 16
# seeds that every two passages share of MIN_WORDS words or more of which a fifth were replaced: a run
# of equal words has SEED_WORDS - 1 seeds fewer than words, and every replaced word ends one run at most
MIN_SEEDS = round(SIMILARITY * MIN_WORDS) - (SEED_WORDS - 1) * (round((1 - SIMILARITY) * MIN_WORDS) + 1)
GAP_COST = 0.05
MIN_ANCHORS = 2
RUN_STEP = 8  # of anchors one word apart, a run, the first, the last and every eighth are chained
MARGIN = 64  # words read on both sides of a chain for its extension
FILTERED = 512  # words of a list up to which it is looked through before it is aligned
KNOWN = 1 << 14  # short alignments that a task remembers
DROP = 8
TABLE_BITS = 1 << 26  # an alignment's table; larger ones are halved


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _written(df: DataFrame, name: str) -> DataFrame:
    """``staged``, after which the shuffle files of the write are removed: nothing reads them again."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return staged(df, name)
    finally:
        conf.set(_CLEANUP, before) if before is not None else conf.unset(_CLEANUP)


def _one_of_each(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The texts without copies (``doc_id, text``), and the copies: ``doc_id, n, first``, n words each.

    Equal texts (by SHA-256) count for the smallest doc_id that has one; it need not be that of a row of its own.
    """
    texts = texts.where(F.octet_length("text") >= 2 * MIN_WORDS - 1)  # others have fewer words
    known = _written(texts.select("doc_id", F.sha2("text", 256).alias("h")), "texts")
    groups = known.groupBy("h").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows"))
    twins = groups.where("rows > 1")
    # words are counted in the first text of each group only
    counted = texts.join(twins.select(F.col("first").alias("doc_id")).distinct(), "doc_id", "left_semi").select(
        F.sha2("text", 256).alias("h"), F.regexp_count("text", F.lit(r"[^ \t\n\x0B\f\r]+")).alias("n")).distinct()
    counted = _written(counted, "counted")  # or the condition on n is pushed down and all texts are counted
    twins = twins.join(counted.where(F.col("n") >= MIN_WORDS), "h")
    copies = by_weight(known, twins, ["h"], "rows", max(1, known.count())).where("doc_id > first")
    firsts = groups.select(F.col("first").alias("doc_id"), "h")
    reps = texts.withColumn("h", F.sha2("text", 256)).join(firsts, ["doc_id", "h"], "left_semi")
    return reps.select("doc_id", "text"), copies.select("doc_id", "n", "first").distinct()


def sliced(texts: DataFrame) -> DataFrame:
    """``slice, ids, texts``: documents in slices of at most one Arrow batch, a long text alone."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                lists = [pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), b.column(i)) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(lists, ["ids", "texts"])

    got = texts.select("doc_id", "text").mapInArrow(run, "ids array<long>, texts array<string>")
    return got.withColumn("slice", F.monotonically_increasing_id())


def _seeds(ids: pa.Array, texts: pa.Array):
    """Seeds of a slice: key, row in the slice and place of each."""
    keys, rows, places = [], [], []
    for row, h in _documents(pa.RecordBatch.from_arrays([ids, texts], ["ids", "texts"]), 1):
        if len(h) >= MIN_WORDS:
            g = window_hashes(h, SEED_WORDS)
            keys.append(g)
            rows.append(np.full(len(g), row))
            places.append(np.arange(len(g)))
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(rows), np.concatenate(places)


def _dense(row: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Whether a seed has MIN_SEEDS around it, itself included, within a passage of MIN_WORDS words; rows in order."""
    at = row * (1 << 40) + pos
    reach = MIN_WORDS - SEED_WORDS
    return np.searchsorted(at, at + reach, "right") - np.searchsorted(at, at - reach) >= MIN_SEEDS


def shared_seeds(slices: DataFrame) -> DataFrame:
    """``key, doc_id, pos``: the seeds that several documents have (and a few more, by equal short keys).

    A slice sends every bucket its different seeds there as four bytes each, so a seed that
    fills a slice is sent once; the bucket answers with a bit for each that other slices
    sent as well.  The number of buckets follows the bytes of text.  Seeds with fewer
    than MIN_SEEDS such seeds near them lie in no passage and are left out.
    """
    spark = slices.sparkSession
    size = slices.select(F.sum(F.aggregate("texts", F.lit(0).cast("long"), lambda a, t: a + F.octet_length(t)))).first()[0]
    bits = max(4, (max(1, size or 0) // BUCKET_BYTES).bit_length())
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (1 << bits) // 4)
    short = np.uint64(32 - bits)

    def ask(batches):
        for b in batches:
            bucket, slice_, keys = [], [], []
            for i in range(b.num_rows):
                g, _, _ = _seeds(b.column(1)[i].values, b.column(2)[i].values)
                u = np.unique(g >> short)
                places, first = np.unique(u >> np.uint64(32), return_index=True)
                low = u.astype(np.uint32)
                for k, lo, hi in zip(places.tolist(), first.tolist(), [*first.tolist()[1:], len(u)]):
                    bucket.append(k)
                    slice_.append(b.column(0)[i].as_py())
                    keys.append(low[lo:hi].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket, pa.int32()), pa.array(slice_, pa.int64()), pa.array(keys, pa.binary())],
                ["bucket", "slice", "keys"])

    def answer(batches):
        def flush(bucket, held):
            every = np.sort(np.concatenate([k for _, k in held]))
            twice = np.unique(every[1:][every[1:] == every[:-1]])
            out = []
            for slice_, k in held:
                at = np.minimum(np.searchsorted(twice, k), max(0, len(twice) - 1))
                known = twice[at] == k if len(twice) else np.zeros(len(k), bool)
                if known.any():
                    out.append((slice_, bucket, np.packbits(known).tobytes()))
            return pa.RecordBatch.from_arrays([pa.array([o[j] for o in out], t) for j, t in enumerate(
                (pa.int64(), pa.int32(), pa.binary()))], ["slice", "bucket", "known"])

        now, held = None, []
        for b in batches:
            for i, k in enumerate(b.column(0).to_pylist()):
                if k != now and held:
                    yield flush(now, held)
                    held = []
                now = k
                held.append((b.column(1)[i].as_py(), np.frombuffer(b.column(2)[i].as_buffer(), np.uint32).copy()))
        if held:
            yield flush(now, held)

    def pick(batches):
        for b in batches:
            for i in range(b.num_rows):
                ids = b.column(1)[i].values
                g, row, pos = _seeds(ids, b.column(2)[i].values)
                if not len(g):
                    continue
                u, first, back = np.unique(g >> short, return_index=True, return_inverse=True)
                last = np.zeros(len(u), np.int64)
                last[back] = np.arange(len(g))
                known = row[first] != row[last]  # in several documents of this slice
                for a in b.column(3)[i].as_py() or ():
                    lo, hi = np.searchsorted(u, np.array([a["bucket"], a["bucket"] + 1], np.uint64) << np.uint64(32))
                    known[lo:hi] |= np.unpackbits(np.frombuffer(a["known"], np.uint8), count=hi - lo).astype(bool)
                keep = known[back]
                keep[keep] = _dense(row[keep], pos[keep])
                doc = ids.to_numpy(zero_copy_only=False)[row[keep]]
                cols = [pa.array(c) for c in (g[keep].view(np.int64), doc, pos[keep])]
                whole = pa.RecordBatch.from_arrays(cols, ["key", "doc_id", "pos"])
                for at in range(0, whole.num_rows, 1 << 17):
                    yield whole.slice(at, 1 << 17)

    asked = slices.select("slice", "ids", "texts").mapInArrow(ask, "bucket int, slice long, keys binary")
    asked = asked.repartition(tasks, "bucket").sortWithinPartitions("bucket")
    answers = _written(asked.mapInArrow(answer, "slice long, bucket int, known binary"), "answers")
    answers = answers.groupBy("slice").agg(F.collect_list(F.struct("bucket", "known")).alias("answers"))
    return slices.join(answers, "slice", "left").select("slice", "ids", "texts", "answers").mapInArrow(
        pick, "key long, doc_id long, pos long")


def _frequent(occurrences: DataFrame) -> tuple[DataFrame, int, int]:
    """``key, doc_id, pos, docs``: the occurrences (a written table) with the documents of their seed if over RARE, else null.

    Second, the links of the other seeds at most; third, the occurrences of the most frequent of those.
    """
    seeds = occurrences.groupBy("key", "doc_id").agg(F.count("*").alias("n")).groupBy("key").agg(
        F.count("*").alias("docs"), F.sum("n").alias("n"))
    n, rare = F.col("n").cast("double"), F.col("docs") <= RARE
    seen = Observation()
    seeds = seeds.observe(
        seen, F.sum(F.when(rare, F.least((F.col("docs") - 1) * n, n * n / 2))).alias("links"), F.max(F.when(rare, n)).alias("most"))
    many = _written(seeds.where(~rare), "often")
    found = by_weight(occurrences, many, ["key"], "n", max(1, occurrences.count()), "left")
    return found.select("key", "doc_id", "pos", "docs"), int(seen.get["links"] or 0), int(seen.get["most"] or 0)


_SEED, _OFTEN, _WINDOW = 0, 1, 2
_PLACE = ["kind", "key", "doc_id", "pos", "hot"]
_PLACES = "kind int, key long, doc_id long, pos long, hot int"


def _chosen(key: np.ndarray, pos: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Whether MIN_SEEDS - 1 frequent seeds of at least as many documents lie within a passage of each frequent one.

    Two windows that share MIN_SEEDS seeds share one that is not among the last MIN_SEEDS - 1 of
    either in any fixed order: only those need partners.
    """
    by = np.lexsort((key, docs))
    step = np.ones(len(by), np.int64)
    step[1:] = (key[by][1:] != key[by][:-1]) | (docs[by][1:] != docs[by][:-1])
    order = np.empty(len(by), np.int64)
    order[by] = np.cumsum(step)
    after = np.zeros(len(by), np.int64)
    for d in range(1, len(by)):
        near = pos[d:] - pos[:-d] <= MIN_WORDS - SEED_WORDS
        if not near.any():
            break
        after[:-d] += near & (order[d:] >= order[:-d])
        after[d:] += near & (order[:-d] >= order[d:])
    return after >= MIN_SEEDS - 1


def _document(doc: int, key: np.ndarray, pos: np.ndarray, docs: np.ndarray) -> list[np.ndarray]:
    """Rows of a document: its rare seeds, the frequent ones that need partners, and runs of MIN_WORDS words around those.

    ``hot`` counts the frequent seeds around a rare one.
    """
    reach = MIN_WORDS - SEED_WORDS
    often = docs > 0
    hot = np.flatnonzero(often)
    rare = np.flatnonzero(~often)
    around = np.searchsorted(pos[hot], pos[rare] + reach, "right") - np.searchsorted(pos[hot], pos[rare] - reach)
    out = [(np.full(len(rare), _SEED), key[rare], pos[rare], around)]
    if len(hot) >= MIN_SEEDS:
        hot = hot[_chosen(key[hot], pos[hot], docs[hot])]
        if len(hot) and len(pos) > reach and (np.diff(pos) > 0).all():  # one text: equal runs of seeds are equal words
            at = np.flatnonzero(pos[reach:] - pos[:-reach] == reach)
            x = pos[at]
            near = np.searchsorted(pos[hot], x + reach, "right") > np.searchsorted(pos[hot], x)
            at, x = at[near], x[near]
            if len(x):
                run = window_hashes(key.view(np.uint64), reach + 1)[at].view(np.int64)
                out.append((np.full(len(x), _WINDOW), run, x, np.zeros(len(x))))
        out.append((np.full(len(hot), _OFTEN), key[hot], pos[hot], np.full(len(hot), MIN_SEEDS)))
    cols = [np.concatenate(c).astype(np.int64) for c in zip(*out)]
    return [*cols[:2], np.full(len(cols[0]), doc), *cols[2:]]


def _places(occurrences: DataFrame) -> DataFrame:
    """The rows of ``_document`` for every document; ``occurrences`` as of ``_frequent``."""

    def flush(cols):
        key, doc, pos, docs = cols
        cut = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1], [True])))
        parts = [_document(int(doc[i]), key[i:j], pos[i:j], docs[i:j]) for i, j in zip(cut[:-1].tolist(), cut[1:].tolist())]
        c = [np.concatenate(x) for x in zip(*parts)]
        whole = pa.RecordBatch.from_arrays(
            [pa.array(x.astype(t)) for x, t in zip(c, (np.int32, *[np.int64] * 3, np.int32))], _PLACE)
        for i in range(0, whole.num_rows, 1 << 17):
            yield whole.slice(i, 1 << 17)

    rows = occurrences.select("key", "doc_id", "pos", F.coalesce("docs", F.lit(0)).alias("docs"))
    return rows.repartition("doc_id").sortWithinPartitions("doc_id", "pos").mapInArrow(_by_group(flush, 1), _PLACES)


def _by_group(flush, *by: int):
    """A function of batches, in order of the columns ``by``, that hands ``flush`` the columns of whole groups."""

    def run(batches):
        held, size = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append([c.to_numpy(zero_copy_only=False) for c in b.columns])
            size += b.num_rows
            if size < 1 << 16:
                continue
            cols = [np.concatenate(c) for c in zip(*held)]
            k = size - int(np.logical_and.reduce([cols[i] == cols[i][-1] for i in by])[::-1].cumprod().sum())
            if k:
                yield from flush([c[:k] for c in cols])
            held, size = [[c[k:] for c in cols]], size - k
        if size:
            yield from flush([np.concatenate(c) for c in zip(*held)])

    return run


_LINK = ["doc_a", "doc_b", "x", "y", "hot"]
_LINKS = "doc_a long, doc_b long, x long, y long, hot int"
_TYPES = (np.int64, np.int64, np.int32, np.int32, np.int8)  # of a link in a packed row
_ROW = (np.int64, np.int64, np.int64, np.int32, np.int8)  # the same of an occurrence: key, label, doc_id, pos, hot
_PACKED = "bucket int, packed binary"


def _bucket(doc_a: np.ndarray, doc_b: np.ndarray, buckets: int) -> np.ndarray:
    a, b = (c.astype(np.int64).view(np.uint64) for c in (doc_a, doc_b))
    return (mix(a * np.uint64(0x9E3779B97F4A7C15) + b) % np.uint64(buckets)).astype(np.int32)


def _packed(cols: list[np.ndarray], types, bucket: np.ndarray) -> pa.RecordBatch:
    """One row for every bucket: its part of all columns, one after the other."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True]))) if len(bucket) else np.zeros(1, np.int64)
    cols = [c[order].astype(t) for c, t in zip(cols, types)]
    packed = [b"".join(c[i:j].tobytes() for c in cols) for i, j in zip(cut[:-1].tolist(), cut[1:].tolist())]
    return pa.RecordBatch.from_arrays([pa.array(bucket[cut[:-1]], pa.int32()), pa.array(packed, pa.binary())], ["bucket", "packed"])


def _pack(links: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    """Links as one row for every bucket of document pairs."""
    links[4] = np.minimum(links[4], MIN_SEEDS)  # more count no more
    return _packed(links, _TYPES, _bucket(links[0], links[1], buckets))


def _unpack(packed: list[bytes], types=_TYPES) -> list[np.ndarray]:
    parts = []
    for p in packed:
        n, at, cols = len(p) // sum(np.dtype(t).itemsize for t in types), 0, []
        for t in types:
            cols.append(np.frombuffer(p, t, n, at))
            at += n * np.dtype(t).itemsize
        parts.append(cols)
    return [np.concatenate(c) for c in zip(*parts)]


def _by_bucket(flush):
    """A function of packed rows, in order of their buckets, that hands ``flush`` those of each bucket."""

    def run(batches):
        now, held = None, []
        for b in batches:
            for bucket, packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if bucket != now and held:
                    yield from flush(held)
                    held = []
                now = bucket
                held.append(packed)
        if held:
            yield from flush(held)

    return run


def _dealt(packed: DataFrame, buckets: int) -> DataFrame:
    tasks = max(int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions")), buckets // 4)
    return packed.repartition(tasks, "bucket").sortWithinPartitions("bucket")


def _pairs(key, part, block, label, doc, pos, hot, wanted=None):
    """Links of all rows of a key and part whose documents and labels differ, and blocks if the part is of two; in chunks.

    The n-th occurrence in a document goes with the n-th in the other, or its last.  ``wanted``: which pairs of documents.
    """
    order = np.lexsort((pos, doc, label, part, key))
    key, part, block, label, doc, pos, hot = (c[order] for c in (key, part, block, label, doc, pos, hot))
    n = len(key)

    def starts(*cols):
        new = np.ones(n, bool)
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
        return new

    at = np.flatnonzero(starts(key, part, label, doc))  # groups: a key in one document
    size = np.diff(np.append(at, n))
    index = np.arange(len(at))
    first, begin = (np.maximum.accumulate(np.where(s[at], index, 0)) for s in (starts(key, part), starts(key, part, label)))
    partners = begin - first  # the groups of other labels before
    longest = np.maximum.reduceat(size, np.flatnonzero(starts(key, part)[at]))[np.cumsum(starts(key, part)[at]) - 1]
    load = np.cumsum(partners * longest)
    lo = 0
    while lo < len(at):
        hi = max(lo + 1, int(np.searchsorted(load, (load[lo - 1] if lo else 0) + (1 << 19), "right")))
        b = np.repeat(index[lo:hi], partners[lo:hi])
        a = np.arange(len(b)) - np.repeat(np.cumsum(partners[lo:hi]) - partners[lo:hi], partners[lo:hi]) + first[b]
        ok = (doc[at[a]] != doc[at[b]]) & ((part[at[b]] < 0) | (block[at[a]] != block[at[b]]))
        a, b = a[ok], b[ok]
        turn = doc[at[a]] > doc[at[b]]
        a, b = np.where(turn, b, a), np.where(turn, a, b)
        if wanted is not None:
            ok = wanted(doc[at[a]], doc[at[b]])
            a, b = a[ok], b[ok]
        rows = np.maximum(size[a], size[b])
        rank = np.arange(int(rows.sum())) - np.repeat(np.cumsum(rows) - rows, rows)
        a, b = np.repeat(a, rows), np.repeat(b, rows)
        a, b = (at[g] + np.minimum(rank, size[g] - 1) for g in (a, b))
        for i in range(0, len(a), 1 << 19):
            p, q = a[i:i + (1 << 19)], b[i:i + (1 << 19)]
            yield [doc[p], doc[q], pos[p], pos[q], np.minimum(hot[p], hot[q])]
        lo = hi


def packed_anchors(occurrences: DataFrame, most: int, buckets: int, passes: int = 1, share: int = 0) -> DataFrame:
    """The links of ``anchors`` in packed rows ``bucket, packed``, of every ``passes``-th bucket only.

    The rows (a written table) of a key meet in one task up to BLOCK rows; more are dealt into blocks by document,
    and every two blocks meet in a task of their own.  ``most``: rows of the most frequent key.
    """
    whole, parted = occurrences, None
    if most > BLOCK:
        sizes = occurrences.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
        sizes = _written(sizes.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "sizes")
        whole = occurrences.join(sizes, "key", "left_anti")
        rows = occurrences.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("doc_id"), "blocks").cast("int"))
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
        rows = rows.select("key", "block", "label", "doc_id", "pos", "hot", "blocks", other)
        # a block with itself is a part below 0
        part = F.when(F.col("block") == F.col("other"), -1 - F.col("block").cast("long")).otherwise(
            F.least("block", "other").cast("long") * F.col("blocks") + F.greatest("block", "other"))
        rows = rows.select("key", part.alias("part"), "block", "label", "doc_id", "pos", "hot")
        parted = rows.repartition("key", "part").sortWithinPartitions("key", "part")

    def linked(cols):
        wanted = None if passes == 1 else lambda a, b: _bucket(a, b, buckets) % passes == share
        for links in _pairs(*cols, wanted):
            yield _pack(links, buckets)

    def gather(batches):
        """Packed rows ``key, label, doc_id, pos, hot`` by key."""
        held, size = [], 0

        def flush():
            cols = [np.concatenate(c) for c in zip(*held)]
            cols[4] = np.minimum(cols[4], MIN_SEEDS)
            return _packed(cols, _ROW, (mix(cols[0].view(np.uint64)) % np.uint64(deal)).astype(np.int32))

        for b in batches:
            if b.num_rows:
                held.append([c.to_numpy(zero_copy_only=False) for c in b.columns])
                size += b.num_rows
            if size >= 1 << 18:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    def pair(packed):
        key, label, doc, pos, hot = _unpack(packed, _ROW)
        yield from linked([key, np.full(len(key), -1), np.zeros(len(key), np.int32), label, doc, pos, hot])

    deal = 1 + occurrences.count() // BUCKET_LINKS
    packed = whole.select("key", "label", "doc_id", "pos", "hot").mapInArrow(gather, _PACKED)
    links = _dealt(packed, deal).mapInArrow(_by_bucket(pair), _PACKED)
    return links if parted is None else links.unionByName(parted.mapInArrow(_by_group(linked, 0, 1), _PACKED))


def packed_links(links: DataFrame, buckets: int, passes: int = 1, share: int = 0) -> DataFrame:
    """Rows of links in packed rows, of every ``passes``-th bucket only."""

    def run(batches):
        for b in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            ok = _bucket(cols[0], cols[1], buckets) % passes == share
            yield _pack([c[ok] for c in cols], buckets)

    return links.select(*_LINK).mapInArrow(run, _PACKED)


def anchors(occurrences: DataFrame) -> DataFrame:
    """``doc_a, doc_b, x, y, hot``: links of all rows ``key, doc_id, pos, hot, label`` of a key whose documents and labels differ."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                cols = _unpack(b.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(t)) for c, t in zip(cols, [np.int64] * 4 + [np.int32])], _LINK)

    return packed_anchors(occurrences, _load(occurrences)[1], 1).mapInArrow(run, _LINKS)


def _load(occurrences: DataFrame) -> tuple[int, int]:
    """The links of ``anchors`` (counting every occurrence in a document with every one in the other), the rows of the most frequent key."""
    n, same = F.sum("n").cast("double"), F.sum(F.col("n").cast("double") * F.col("n"))
    keys = occurrences.groupBy("key", "label").agg(F.count("*").alias("n")).groupBy("key").agg(
        n.alias("n"), ((n * n - same) / 2).alias("links"))
    r = keys.agg(F.sum("links").alias("links"), F.max("n").alias("most")).first()
    return int(r["links"] or 0), int(r["most"] or 0)


def _shared_runs(places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Runs of MIN_WORDS words that documents share: links to the first document of each, and ``key, doc_id, pos, n`` of all."""
    runs = places.where(F.col("kind") == _WINDOW).select("key", "doc_id", "pos")
    first = runs.groupBy("key").agg(F.min(F.struct("doc_id", "pos")).alias("f"), F.count("*").alias("n")).where("n > 1")
    first = _written(first, "first-runs")
    joined = _written(by_weight(runs, first, ["key"], "n", max(1, runs.count())), "runs")
    links = joined.where("doc_id <> f.doc_id").select(
        F.col("f.doc_id").alias("doc_a"), F.col("doc_id").alias("doc_b"),
        F.explode(F.array(*[F.struct((F.col("f.pos") + k).alias("x"), (F.col("pos") + k).alias("y"))
                            for k in (0, MIN_WORDS - SEED_WORDS)])).alias("p"),
    ).select("doc_a", "doc_b", "p.x", "p.y", F.lit(MIN_SEEDS).alias("hot")).distinct()
    return links, joined.select("key", "doc_id", "pos", "n")


def _most_shared(pos: np.ndarray, begin: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """For every seed the index of the run (``begin`` in order) around it that occurs most often, by the larger key of equal ones, or -1."""
    if not len(begin):
        return np.full(len(pos), -1)
    by = np.lexsort((key, n))
    best = np.full(max(int(begin[-1]), int(pos.max(initial=0))) + 1, -1)
    best[begin[by]] = np.arange(len(by))
    left, width = MIN_WORDS - SEED_WORDS, 1
    while left:  # the best of the ``width`` places up to each one
        step = min(width, left)
        best[step:] = np.maximum(best[step:], best[:-step])
        left, width = left - step, width + step
    best = best[pos]
    return np.where(best >= 0, by[best], -1)


def _labelled(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """``key, doc_id, pos, label``: the frequent seeds, with the most shared run around each as a label, or else the document.

    Two documents have one label at a seed only where an equal run of MIN_WORDS words holds it in both:
    each of them is linked with the first document that has this run, so not with each other here.
    """

    def flush(cols):
        doc, _, key, n = cols
        cut = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1], [True])))
        seeds, run = [], []
        for i, j in zip(cut[:-1].tolist(), cut[1:].tolist()):
            seed = i + np.flatnonzero(n[i:j] == 0)
            at = i + np.flatnonzero(n[i:j] > 0)
            best = _most_shared(cols[1][seed], cols[1][at], n[at], key[at])
            seeds.append(seed)
            run.append(np.where(best >= 0, at[best], -1) if len(at) else best)
        seeds, run = np.concatenate(seeds), np.concatenate(run)
        whole = pa.RecordBatch.from_arrays(
            [*(pa.array(c[seeds]) for c in (key, doc, cols[1])), pa.array(key[run], mask=run < 0)], ["key", "doc_id", "pos", "label"])
        for i in range(0, whole.num_rows, 1 << 17):
            yield whole.slice(i, 1 << 17)

    both = rows.select("doc_id", "pos", "key", F.lit(0).cast("long").alias("n")).unionByName(runs.select("doc_id", "pos", "key", "n"))
    found = both.repartition("doc_id").sortWithinPartitions("doc_id", "pos").mapInArrow(
        _by_group(flush, 0), "key long, doc_id long, pos long, label long")
    return found.withColumn("label", F.coalesce("label", F.xxhash64("doc_id")))


def _with_words(h: np.ndarray, key: np.ndarray, pos: np.ndarray, order: np.ndarray):
    """Keys of frequent seeds with words near them, and the row of each in ``key``.

    Two windows of MIN_WORDS words that share a seed and four fifths of their words share one of
    the PREFIX rarest of the others, in any fixed order of words.  A word is taken if it is among
    them in one of the windows of the text around the seed and itself: the words of a frequent line
    are not, where the other words of every window are rarer.
    """
    rank = order[h >> np.uint64(64 - ORDER_BITS)].astype(np.int64)
    reach = MIN_WORDS - SEED_WORDS
    if len(h) < MIN_WORDS or not len(pos):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # the rank of the last word taken of every window; four words more where the seed's own may be rarer
    last = (PREFIX - 1, PREFIX - 1 + SEED_WORDS)
    begin = np.unique(np.clip(pos[:, None] - reach + np.arange(reach + 1), 0, len(h) - MIN_WORDS))
    most = np.full((2, len(h) + reach + 1), -1, np.int64)  # -1: no window begins there
    for i in range(0, len(begin), 1 << 14):
        at = begin[i:i + (1 << 14)]
        most[:, at + reach] = np.partition(sliding_window_view(rank, MIN_WORDS)[at], last, axis=1)[:, last].T
    most = most[:, pos[:, None] + np.arange(reach + 1)]  # of the windows around a seed, the first one first
    seed = rank[pos[:, None] + np.arange(SEED_WORDS)].min(1)[:, None]
    until = np.maximum.accumulate(most, axis=2)[:, :, :-1]
    onward = np.maximum.accumulate(most[:, :, ::-1], axis=2)[:, :, -2::-1]
    keys, rows = [], []
    for first, limit in ((-reach, until), (SEED_WORDS, onward)):  # words before the seed, words after it
        at = pos[:, None] + first + np.arange(reach)
        there = (at >= 0) & (at < len(h))
        near = rank[np.clip(at, 0, len(h) - 1)]
        row, k = np.nonzero(there & (near <= np.where(near < seed, limit[0], limit[1])))
        keys.append(mix(key[row].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + h[at[row, k]]))
        rows.append(row)
    return np.concatenate(keys), np.concatenate(rows)


def _often(texts: DataFrame, places: DataFrame, runs: DataFrame) -> DataFrame:
    """``key, doc_id, pos, hot, label``: the frequent seeds of several labels, those of more than FEW with the words near them as keys.

    A pair of near copies shares a dozen such words at every seed, so the words are for seeds
    that join too many others by themselves.
    """
    spark = texts.sparkSession
    rows = _written(_labelled(places.where(F.col("kind") == _OFTEN).select("key", "doc_id", "pos"), runs), "frequent")
    several = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    several = _written(several.where("lo <> hi").select("key", "n"), "several")
    rows = by_weight(rows, several, ["key"], "n", max(1, rows.count()))
    few = rows.where(F.col("n") <= FEW).select("key", "doc_id", "pos", F.lit(MIN_SEEDS).alias("hot"), "label")
    asked = rows.where(F.col("n") > FEW).groupBy("doc_id").agg(F.collect_list(F.struct("key", "pos", "label")).alias("asked"))
    found = _written(texts.join(asked, "doc_id").select("doc_id", "text", "asked"), "asked")

    def count(batches):
        total = np.zeros(1 << ORDER_BITS, np.int64)
        for b in batches:
            for _, h in _documents(b, 0):
                total += np.bincount((h >> np.uint64(64 - ORDER_BITS)).astype(np.int64), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["word", "n"])

    # a count for every 2**ORDER_BITS-th part of the words: a bounded table; it only decides which words are asked first
    order = np.zeros(1 << ORDER_BITS, np.int64)
    for r in found.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():
        order[r["word"]] = r["n"]
    order = np.lexsort((np.arange(len(order)), order)).argsort().astype(np.int32)
    shared = spark.sparkContext.broadcast(order)

    def run(batches):
        for b in batches:
            ids, lists = b.column(0).to_pylist(), b.column(2)
            for row, h in _documents(b, 1):
                flat = lists[row].values
                key, pos, label = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("key", "pos", "label"))
                for i in range(0, len(key), 1 << 12):
                    k, p, c = (x[i:i + (1 << 12)] for x in (key, pos, label))
                    ok = p + SEED_WORDS <= len(h)
                    k, p, c = k[ok], p[ok], c[ok]
                    if not len(k):
                        continue
                    new, at = _with_words(h, k, p, shared.value)
                    pair = np.unique(np.stack((new.view(np.int64), at)), axis=1)
                    cols = [pair[0], np.full(pair.shape[1], ids[row]), p[pair[1]], np.full(pair.shape[1], MIN_SEEDS, np.int32), c[pair[1]]]
                    whole = pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["key", "doc_id", "pos", "hot", "label"])
                    for j in range(0, whole.num_rows, 1 << 17):
                        yield whole.slice(j, 1 << 17)

    made = _written(found.mapInArrow(run, "key long, doc_id long, pos long, hot int, label long"), "worded")
    drop_staged(found)
    several = made.groupBy("key").agg(F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    several = _written(several.where("lo <> hi").select("key", "n"), "several")
    kept = by_weight(made, several, ["key"], "n", max(1, made.count())).drop("n")
    kept = _written(kept.unionByName(few), "worded")
    drop_staged(made)
    return kept


class Fenwick:
    """Prefix maxima with the index that holds them."""

    def __init__(self, n: int):
        self.value = [-1e18] * (n + 1)
        self.index = [-1] * (n + 1)

    def add(self, i: int, value: float, index: int) -> None:
        i += 1
        while i < len(self.value):
            if value > self.value[i]:
                self.value[i], self.index[i] = value, index
            i += i & -i

    def best(self, i: int) -> tuple[float, int]:
        """The largest of the places before ``i``."""
        value, index = -1e18, -1
        while i > 0:
            if self.value[i] > value:
                value, index = self.value[i], self.index[i]
            i -= i & -i
        return value, index


def chains(x: np.ndarray, y: np.ndarray, least: int = MIN_ANCHORS) -> list[np.ndarray]:
    """Chains of ``least`` anchors ``(x, y)`` or more, as index arrays in order, best first; each anchor is in one at most.

    An anchor scores SEED_WORDS; a step costs GAP_COST for every word it moves in
    either document; places rise strictly in both.
    """
    order = np.lexsort((-y, x))
    xs, ys = x[order].tolist(), y[order].tolist()
    score, back = [0.0] * len(xs), [-1] * len(xs)
    rising = bool((np.diff(x[order]) > 0).all() and (np.diff(y[order]) > 0).all())
    if rising:  # every anchor can follow all before it, of which the last one is the best
        value = -1e18
        for i in range(len(xs)):
            place = GAP_COST * (xs[i] + ys[i])
            gain = value - place if i else 0.0
            score[i] = SEED_WORDS + max(gain, 0.0)
            back[i] = i - 1 if gain > 0 else -1
            value = score[i] + place
    rank = [] if rising else np.searchsorted(np.unique(y), y[order]).tolist()
    tree = Fenwick(len(set(rank)))
    for i in range(len(rank)):  # equal x: larger y first, so none of them precedes another
        value, j = tree.best(rank[i])
        gain = value - GAP_COST * (xs[i] + ys[i]) if j >= 0 else 0.0
        score[i] = SEED_WORDS + max(gain, 0.0)
        back[i] = j if gain > 0 else -1
        tree.add(rank[i], score[i] + GAP_COST * (xs[i] + ys[i]), i)
    used, out = [False] * len(xs), []
    for i in sorted(range(len(xs)), key=lambda i: (-score[i], i)):
        path = []
        while i >= 0 and not used[i]:
            used[i] = True
            path.append(i)
            i = back[i]
        if len(path) >= least:
            out.append(order[path[::-1]])
    return out


def thinned(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Indices of the anchors that stand for all: both ends of every run of anchors one word apart, and steps between.

    The words between them are equal, so a chain over the run covers the same words.
    """
    order = np.lexsort((x, y - x))
    x, y = x[order], y[order]
    new = np.ones(len(x) + 1, bool)
    new[1:-1] = (np.diff(x) != 1) | (np.diff(y) != 1)
    index = np.arange(len(x))
    start = np.maximum.accumulate(np.where(new[:-1], index, 0))
    return np.sort(order[new[1:] | ((index - start) % RUN_STEP == 0)])


def candidates(links: DataFrame, buckets: int) -> DataFrame:
    """``doc_a, a0, a1, doc_b, b0, b1``: the word ranges of every chain, from packed links.

    Links of a pair of documents meet in one task.  A chain is kept if MIN_SEEDS links lie
    around it, counting the frequent seeds around a link (``hot``), which may be shared.
    """

    def find(x, y, hot):
        """Places of the first and the last link of every chain of one pair."""
        kept = thinned(x, y)
        paths = chains(x[kept], y[kept], 1 if hot.any() else MIN_ANCHORS)
        first, last = (kept[np.array([p[k] for p in paths], np.int64)] for k in (0, -1))
        places = np.sort(y)
        near = np.searchsorted(places, y[last] + MIN_WORDS) - np.searchsorted(places, y[first] - MIN_WORDS)
        ok = near + int(hot.min()) >= MIN_SEEDS
        for i in np.flatnonzero(~ok & (near + int(hot.max()) >= MIN_SEEDS)).tolist():
            within = (y >= y[first[i]]) & (y <= y[last[i]])
            ok[i] = near[i] + int(hot[within].max()) >= MIN_SEEDS
        return first[ok], last[ok]

    def flush(packed):
        a, b, x, y, hot = _unpack(packed)
        place = x.astype(np.int64) << 32 | y
        order = np.lexsort((place, b, a))
        a, b, place, hot = (c[order] for c in (a, b, place, hot))
        pair = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
        one = pair | np.append(True, place[1:] != place[:-1])
        hot = np.maximum.reduceat(hot, np.flatnonzero(one)).astype(np.int64)
        a, b, place, pair = (c[one] for c in (a, b, place, pair))
        cut = np.append(np.flatnonzero(pair), len(pair))
        enough = np.diff(cut) + np.maximum.reduceat(hot, cut[:-1]) >= MIN_SEEDS
        x, y = place >> 32, place & 0xFFFFFFFF
        # pairs whose links are one run of equal words: a chain as they stand
        broken = ~pair & (np.append(0, np.diff(place)) != (1 << 32 | 1))
        run = np.add.reduceat(broken, cut[:-1]) == 0
        first, last = [cut[:-1][enough & run]], [cut[1:][enough & run] - 1]
        for i, j in zip(cut[:-1][enough & ~run].tolist(), cut[1:][enough & ~run].tolist()):
            f, k = find(x[i:j], y[i:j], hot[i:j])
            first.append(f + i)
            last.append(k + i)
        f, k = np.concatenate(first), np.concatenate(last)
        cols = [a[f], x[f], x[k] + SEED_WORDS, b[f], y[f], y[k] + SEED_WORDS]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["doc_a", "a0", "a1", "doc_b", "b0", "b1"])

    return _dealt(links, buckets).mapInArrow(_by_bucket(flush), "doc_a long, a0 long, a1 long, doc_b long, b0 long, b1 long")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, by bits."""
    if len(a) == len(b) and (a == b).all():
        return len(a)
    where: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        where[w] = where.get(w, 0) | 1 << i
    row = full = (1 << len(a)) - 1
    for w in b.tolist():
        m = where.get(w)
        if m:
            u = row & m
            row = row + u | row - u  # bits above those of ``a`` change none below
    return len(a) - (row & full).bit_count()


def _extend(a: np.ndarray, b: np.ndarray) -> tuple[int, int, bool, bool]:
    """Words by which an end moves in ``a`` and in ``b``, and whether it ran out of the words of either.

    Greedy alignment by the number of errors: an equal word scores 1, a replaced one -2, a
    word of one text only -2.5; it goes on until DROP lost against the best.
    """
    a, b = a.tolist(), b.tolist()
    n, m = len(a), len(b)
    best, at, out_a, out_b = 0.0, (0, 0), False, False
    reach, errors = {0: 0}, 0  # for every shift between the texts the furthest word of ``a``
    while reach:
        following: dict[int, int] = {}
        for shift, i in reach.items():
            j = i - shift
            while i < n and j < m and a[i] == b[j]:
                i, j = i + 1, j + 1
            score = (i + j) / 2 - 3 * errors
            if score > best:
                best, at = score, (i, j)
            if best - score > DROP:
                continue
            out_a, out_b = out_a or i == n, out_b or j == m
            for d, u in ((shift, i + 1), (shift + 1, i + 1), (shift - 1, i)):
                if u <= n and u - d <= m and u > following.get(d, -1):
                    following[d] = u
        reach, errors = following, errors + 1
    return *at, out_a, out_b


def _rows(a: list[int], b: list[int]):
    """After every word of ``b``: bits of ``a``'s places, 0 where the common subsequence with ``b`` so far grows."""
    where: dict[int, int] = {}
    for i, w in enumerate(a):
        where[w] = where.get(w, 0) | 1 << i
    row = full = (1 << len(a)) - 1
    for w in b:
        u = row & where.get(w, 0)
        row = (row + u | row - u) & full
        yield row


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of every prefix of ``a`` with ``b``."""
    row = (1 << len(a)) - 1
    for row in _rows(a, b):
        pass
    bits = np.frombuffer(row.to_bytes(len(a) // 8 + 1, "little"), np.uint8)
    return np.concatenate(([0], np.cumsum(1 - np.unpackbits(bits, bitorder="little")[:len(a)].astype(np.int64))))


def _matches(a: list[int], b: list[int], rows: list[int] | None = None) -> list[tuple[int, int]]:
    """Places of a longest common subsequence; ``rows``: those of ``_rows`` if there already."""
    if len(a) * len(b) > TABLE_BITS and len(b) > 1:
        mid = len(b) // 2
        cut = int((_lengths(a, b[:mid]) + _lengths(a[::-1], b[mid:][::-1])[::-1]).argmax())
        return _matches(a[:cut], b[:mid]) + [(i + cut, j + mid) for i, j in _matches(a[cut:], b[mid:])]
    rows, out = rows or list(_rows(a, b)), []
    i, j = len(a), len(b)
    while i and j:
        if rows[j - 1] >> i - 1 & 1:
            i -= 1
        else:
            j -= 1
            if not j or rows[j - 1] >> i - 1 & 1:
                i -= 1
                out.append((i, j))
    # places are the leftmost ones; equal words right before a place belong to its passage
    for k in range(1, len(out)):
        i, j = out[k - 1]
        if a[i - 1] == b[j - 1]:
            out[k] = i - 1, j - 1
    return out[::-1]


def pieces(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int]]:
    """Ranges ``first, last`` of matched places that are long and similar enough, apart from each other.

    The range with the most words in common, less two for every other word, comes first; the
    places on both sides of it are searched in the same way.
    """
    other = np.zeros(len(x), np.int64)
    np.cumsum(np.maximum(np.diff(x), np.diff(y)) - 1, out=other[1:])
    least = round(SIMILARITY * MIN_WORDS)
    out, left = [], [(0, len(x))]
    while left:
        lo, hi = left.pop()
        best, at = -np.inf, None
        step = max(1, (1 << 18) // max(1, hi - lo))
        for i in range(lo, hi - least + 1, step):  # first places of ranges; fewer words than ``least`` are no passage
            if hi - i < best:
                break
            first, last = np.arange(i, min(i + step, hi - least + 1))[:, None], np.arange(i + least - 1, hi)
            la, lb, same = x[last] - x[first] + 1, y[last] - y[first] + 1, last - first + 1
            good = (np.minimum(la, lb) >= MIN_WORDS) & (same >= SIMILARITY * np.maximum(la, lb))
            if good.any():
                score = np.where(good, same - 2.0 * (other[last] - other[first]), -np.inf)
                k, m = divmod(int(score.argmax()), len(last))
                if score[k, m] > best:
                    best, at = score[k, m], (i + k, int(last[m]))
        if at:
            out.append(at)
            left += [(lo, at[0]), (at[1] + 1, hi)]
    return sorted(out)


def may_hold(wa: pa.ListArray, wb: pa.ListArray) -> np.ndarray:
    """Whether the words around a chain can hold a passage: in both lists, a range long enough has enough words of the other.

    A passage of L words has SIMILARITY * L in common with the other side, so as many occur there.
    Words are looked up by 12 bits, which can only let more chains through, and lists over
    FILTERED words are let through.
    """
    return _may_hold(*zip(*((w.flatten().to_numpy().view(np.uint64), np.diff(w.offsets.to_numpy())) for w in (wa, wb))))


def _may_hold(flat, size) -> np.ndarray:
    """``may_hold`` of the words of all lists one after the other, and the size of each; for both sides."""
    n = len(size[0])
    row = [np.repeat(np.arange(n), s) for s in size]
    bits = [(f & f.dtype.type(0xFFF)).astype(np.int64) for f in flat]
    out = np.ones(n, bool)
    for here, there in ((0, 1), (1, 0)):
        known = np.zeros((n, 1 << 12), bool)
        known[row[there], bits[there]] = True
        at = np.arange(len(row[here])) - np.repeat(np.cumsum(size[here]) - size[here], size[here])
        short = at < FILTERED
        step = np.full((n, 1 + min(FILTERED, int(size[here].max(initial=0)))), -SIMILARITY)
        step[:, 0] = 0
        step[row[here][short], at[short] + 1] += known[row[here], bits[here]][short]
        total = np.cumsum(step, axis=1)
        least = np.minimum.accumulate(total, axis=1)[:, :-MIN_WORDS]
        out &= (total[:, MIN_WORDS:] >= least - 1e-6).any(axis=1) | (size[here] > FILTERED)
    return out


def align(a: np.ndarray, b: np.ndarray, a0: int, a1: int, b0: int, b1: int):
    """The aligned passages at a chain: their ranges in both word arrays and the words in common.

    Second, whether words before ``a``, before ``b``, after ``a`` or after ``b`` could change them.
    """
    ends = [False] * 4
    least = SIMILARITY * MIN_WORDS
    k = min(a1 - a0, b1 - b0)  # so many in common at least, from the chain's first words on or up to its last ones
    every = max(int((a[a0:a0 + k] == b[b0:b0 + k]).sum()), int((a[a1 - k:a1] == b[b1 - k:b1]).sum()))
    known, rows = every >= least, None
    if not known and len(a) * len(b) <= TABLE_BITS >> 9 and len(b):  # short: most are looked at again below
        rows = list(_rows(a.tolist(), b.tolist()))
        every = len(a) - rows[-1].bit_count()
    elif not known:
        every = _common(a, b)
    if every < least:  # every passage found here lies within these words
        return [], ends

    def grown(la, ha, lb, hb):
        i, j, *before = _extend(a[:la][::-1], b[:lb][::-1])
        k, m, *after = _extend(a[ha:], b[hb:])
        ends[:] = [x or y for x, y in zip(ends, before + after)]
        return la - i, ha + k, lb - j, hb + m

    def similar(la, ha, lb, hb):
        """The words in common of a range that is long and similar enough, or 0."""
        if min(ha - la, hb - lb) < MIN_WORDS:
            return 0
        same = _common(a[la:ha], b[lb:hb])
        return same if same >= SIMILARITY * max(ha - la, hb - lb) else 0

    whole = grown(a0, a1, b0, b1)
    same = similar(*whole)
    if same:
        return [(*whole, same)], ends
    # not as a whole: the parts of the chain and the words around it
    la, lb = max(0, a0 - MARGIN), max(0, b0 - MARGIN)
    near_a, near_b = a[la:a1 + MARGIN], b[lb:b1 + MARGIN]
    ends[:] = [False] * 4
    if len(near_a) + len(near_b) < len(a) + len(b):
        every, rows = every if known else _common(near_a, near_b), None
    if min(len(near_a), len(near_b)) < MIN_WORDS or every < least:
        return [], ends
    places = np.array(_matches(near_a.tolist(), near_b.tolist(), rows), np.int64)
    x, y = places[:, 0] + la, places[:, 1] + lb
    out = []
    for i, j in pieces(x, y):
        part = int(x[i]), int(x[j]) + 1, int(y[i]), int(y[j]) + 1
        more = grown(*part)
        same = similar(*more)
        out.append((*more, same) if same else (*part, j - i + 1))
    return out, ends


def _starts(size: np.ndarray) -> np.ndarray:
    return np.cumsum(size) - size


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of all ranges, one after the other."""
    return np.repeat(first - _starts(size), size) + np.arange(int(size.sum()))


def _binary(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows of a binary column, one after the other, and how many each row has."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    width = np.dtype(kind).itemsize
    flat = np.frombuffer(data, kind, int(off[-1] - off[0]) // width, int(off[0])) if data is not None else np.zeros(0, kind)
    return flat, np.diff(off) // width


_SENT = ["chain", "a0", "a1", "b0", "b1", "low", "at", "size", "after"]


def _send(doc: int, h: np.ndarray, asked: pa.StructArray, margin: int, kind) -> list[list]:
    """For every other document, the chains asked for and the words of this one around them, those of several chains once."""
    chain, a0, a1, other, b0, b1 = (asked.field(k).to_numpy(zero_copy_only=False) for k in ("chain", "a0", "a1", "doc_b", "b0", "b1"))
    order = np.lexsort((a0, other))
    order = order[a1[order] <= len(h)]
    if not len(order):
        return []
    chain, a0, a1, other, b0, b1 = (c[order] for c in (chain, a0, a1, other, b0, b1))
    low, high = np.maximum(0, a0 - margin), np.minimum(len(h), a1 + margin)
    new = np.append(True, other[1:] != other[:-1])
    shift = np.cumsum(new) * (len(h) + 1)
    top = np.maximum.accumulate(high + shift) - shift  # the furthest word of a document's chains so far
    apart = new | np.append(True, low[1:] > top[:-1])
    part = np.cumsum(apart) - 1
    begin, end = low[apart], top[np.append(np.flatnonzero(apart)[1:], len(top)) - 1]
    at = _starts(end - begin)[part] + low - begin[part]
    pair = np.flatnonzero(new)
    words = h[_ranges(begin, end - begin)].astype(kind)
    from_, until = at[pair], np.append(at[pair][1:], len(words))
    at = at - from_[np.cumsum(new) - 1]
    rows = np.stack((chain, a0, a1, b0, b1, low, at, high - low, len(h) - high), 1).astype(np.int64)
    return [[int(other[i]), doc, rows[i:j].tobytes(), words[u:v].tobytes()] for i, j, u, v in zip(
        pair.tolist(), np.append(pair[1:], len(order)).tolist(), from_.tolist(), until.tolist())]


def _meeting(texts: DataFrame, found: DataFrame, margin: int, kind, act, schema: str) -> DataFrame:
    """What ``act`` makes of the chains ``found``, each with the words around it in both documents.

    Chains go to their first document and on to the second, with the words of the first one (``kind``: how many bytes of each hash).
    ``act`` has the second document and its words, the first documents, the columns _SENT, the words sent and where those
    of each chain begin.  Requests to one document come in groups of about SENT words, however many chains it is in.
    """
    def groups(doc):
        return found.groupBy(doc).agg(F.ceil(F.sum(F.col("a1") - F.col("a0") + 2 * margin) / SENT).alias("groups"))

    stretch = F.floor(F.col("a0") / (1 << 16))
    asked = found.join(groups("doc_a"), "doc_a").groupBy("doc_a", F.pmod(F.xxhash64("doc_b", stretch), "groups").alias("g")).agg(
        F.collect_list(F.struct("chain", "a0", "a1", "doc_b", "b0", "b1")).alias("asked"))

    def send(batches):
        for b in batches:
            ids, rows = b.column(0).to_pylist(), []
            for row, h in _documents(b, 1):
                rows += _send(ids[row], h, b.column(2)[row].values, margin, kind)
            types = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 4, types)], ["doc_b", "doc_a", "chains", "words"])

    sent = texts.join(asked.withColumnRenamed("doc_a", "doc_id"), "doc_id").select("doc_id", "text", "asked").mapInArrow(
        send, "doc_b long, doc_a long, chains binary, words binary")
    met = sent.join(groups("doc_b"), "doc_b").groupBy("doc_b", F.pmod(F.xxhash64("doc_a"), "groups").alias("g")).agg(
        F.collect_list(F.struct("doc_a", "chains", "words")).alias("asked"))

    def meet(batches):
        for b in batches:
            ids = b.column(0).to_pylist()
            for row, h in _documents(b, 1):
                asked = b.column(2)[row].values
                flat, size = _binary(asked.field("chains"), np.int64)
                words, count = _binary(asked.field("words"), kind)
                rows = flat.reshape(-1, len(_SENT))
                pair = np.repeat(np.arange(len(size)), size // len(_SENT))
                ok = rows[:, _SENT.index("b1")] <= len(h)
                c = dict(zip(_SENT, rows[ok].T))
                pair = pair[ok]
                if len(pair):
                    doc_a = asked.field("doc_a").to_numpy(zero_copy_only=False)[pair]
                    yield act(ids[row], h, doc_a, c, words, _starts(count)[pair] + c["at"])

    return texts.join(met.withColumnRenamed("doc_b", "doc_id"), "doc_id").select("doc_id", "text", "asked").mapInArrow(meet, schema)


def possible(texts: DataFrame, found: DataFrame) -> DataFrame:
    """``chain``: those of the chains ``found`` around which a passage may lie (``may_hold``); two bytes of every word are sent."""

    def act(doc, h, doc_a, c, words, at):
        h = h.astype(np.uint16)
        low = np.maximum(0, c["b0"] - MARGIN)
        size = np.minimum(len(h), c["b1"] + MARGIN) - low
        out = []
        for i in range(0, len(at), 1 << 11):
            k = slice(i, i + (1 << 11))
            lists = words[_ranges(at[k], c["size"][k])], h[_ranges(low[k], size[k])]
            out.append(c["chain"][k][_may_hold(lists, (c["size"][k], size[k]))])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(out))], ["chain"])

    return _meeting(texts, found, MARGIN, np.uint16, act, "chain long")


def fuzzy_passages(docs: DataFrame) -> DataFrame:
    """``doc_id, start_word, end_word, other_id, other_start, other_end, matched, similarity``.

    One row for every passage of at least MIN_WORDS words that ``doc_id`` has in common
    with a smaller ``other_id``; the words in common are at least SIMILARITY of the longer side.
    Words are runs of bytes other than ASCII white space.  Null, empty and short
    texts have no passages; rows without a doc_id are left out; rows that repeat a
    doc_id are texts of one document, and a passage found in any of them counts.  A copy
    of an equal text has one row, with the smallest doc_id that has it, whose other rows
    hold for the copy too.
    """
    arrow_limits(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(
        "doc_id is not null")
    texts, copies = _one_of_each(texts)
    slices = _written(sliced(texts), "slices")
    texts = slices.select(F.inline(F.arrays_zip(F.col("ids").alias("doc_id"), F.col("texts").alias("text"))))
    occurrences = _written(shared_seeds(slices), "seeds")
    marked, load, most = _frequent(occurrences)
    places = _written(_places(marked), "places")
    drop_staged(occurrences)
    rare = places.where(F.col("kind") == _SEED).select("key", "doc_id", "pos", "hot", F.col("doc_id").alias("label"))
    runs, shared = _shared_runs(places)
    worded = _often(texts, places, shared)
    more, longest = _load(worded)
    # the links of a share of the document pairs at a time, or their shuffle fills the disk
    passes = 1 + (load + more) // LINKS
    buckets = passes * (1 + (load + more) // passes // BUCKET_LINKS)
    found = None
    for k in range(passes):
        links = packed_anchors(rare, most, buckets, passes, k).unionByName(
            packed_anchors(worded, longest, buckets, passes, k)).unionByName(packed_links(runs, buckets, passes, k))
        part = _written(candidates(links, buckets), "chains")
        found = part if found is None else found.unionByName(part)
    drop_staged(places)
    drop_staged(worded)
    found = staged(found.withColumn("chain", F.monotonically_increasing_id()), "chains")
    short = F.greatest(F.col("a1") - F.col("a0"), F.col("b1") - F.col("b0")) < MIN_WORDS
    kept = _written(possible(texts, found.where(short)), "possible")
    found = staged(found.where(~short).unionByName(found.where(short).join(kept, "chain", "left_semi")), "chains")
    rows, margin = None, MARGIN
    while True:  # chains whose passages reach the last word read are read again with more words
        size = found.agg(F.sum(F.col("a1") - F.col("a0") + 2 * margin)).first()[0]
        done, shares = None, 1 + (size or 0) // SHARE
        for k in range(shares):  # as above: the words around the chains of a share at a time
            share = found.where(F.pmod(F.xxhash64("doc_a", "doc_b"), F.lit(shares)) == k)
            part = _written(_aligned(texts, share, margin), "aligned")
            done = part if done is None else done.unionByName(part)
        part = done.where("not open")
        rows = part if rows is None else rows.unionByName(part)
        found = staged(found.join(done.where("open").select("chain").distinct(), "chain", "left_semi"), "chains")
        if found.isEmpty():
            break
        margin *= 8
    same = copies.select("doc_id", F.lit(0).cast("long").alias("start_word"), F.col("n").cast("long").alias("end_word"),
                         F.col("first").alias("other_id"), F.lit(0).cast("long").alias("other_start"),
                         F.col("n").cast("long").alias("other_end"), F.col("n").cast("long").alias("matched"))
    return rows.select(*_NAMES).distinct().unionByName(same).withColumn(
        "similarity", F.col("matched") / F.greatest(F.col("end_word") - F.col("start_word"),
                                                    F.col("other_end") - F.col("other_start")))


def _renamed(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of both as small numbers by first place, all those of one side only as -1 and -2: as equal to each other as before."""
    _, first, word = np.unique(np.concatenate((a, b)), return_index=True, return_inverse=True)
    left, right = np.zeros(len(first), bool), np.zeros(len(first), bool)
    left[word[:len(a)]] = right[word[len(a):]] = True
    name = np.empty(len(first), np.int32)
    name[np.argsort(np.where(left & right, first, len(word)), kind="stable")] = np.arange(len(first))
    name[~right], name[~left] = -1, -2
    word = name[word]
    return word[:len(a)], word[len(a):]


def _aligned(texts: DataFrame, found: DataFrame, margin: int) -> DataFrame:
    """The passages at every chain, or one row that is ``open``: they may go on after the ``margin`` words read."""
    names = ["chain", "open", *_NAMES]
    shapes: dict = {}  # in every task, what came out for the same equal words at the same places

    def shape(wa, wb, *place):
        a, b = _renamed(wa, wb)
        key = (*place, a.tobytes(), b.tobytes())
        if key not in shapes:
            if len(shapes) >= KNOWN:
                shapes.clear()
            shapes[key] = align(a, b, *place)
        return shapes[key]

    def act(doc, h, doc_a, c, words, at):
        rows, known = [], {}
        cols = [doc_a, at, *(c[k] for k in ("chain", "a0", "a1", "b0", "b1", "low", "size", "after"))]
        for other, w, chain, a0, a1, b0, b1, la, size, after in zip(*(x.tolist() for x in cols)):
            lb = max(0, b0 - margin)
            wa, wb = words[w:w + size], h[lb:b1 + margin]
            # texts that repeat words have the same words around many of their chains
            place = (a0 - la, a1 - la, b0 - lb, b1 - lb)
            key = (*place, wa.tobytes(), wb.tobytes())
            if key not in known:
                known[key] = (shape if size + len(wb) <= FILTERED else align)(wa, wb, *place)
            hits, ends = known[key]
            if any(e and r for e, r in zip(ends, (la, lb, after, len(h) - b1 - margin > 0))):
                rows.append((chain, 1, *[0] * len(_NAMES)))
                continue
            for x0, x1, y0, y1, same in hits:
                rows.append((chain, 0, doc, y0 + lb, y1 + lb, other, x0 + la, x1 + la, same))
        r = np.array(rows, np.int64).reshape(-1, len(names))
        cols = [pa.array(r[:, k]) for k in range(len(names))]
        cols[1] = pa.array(r[:, 1] != 0)
        return pa.RecordBatch.from_arrays(cols, names)

    return _meeting(texts, found, margin, np.uint64, act, "chain long, open boolean, " + ", ".join(f"{n} long" for n in _NAMES))


_NAMES = ["doc_id", "start_word", "end_word", "other_id", "other_start", "other_end", "matched"]


def op5(docs: DataFrame) -> DataFrame:
    return fuzzy_passages(docs)
