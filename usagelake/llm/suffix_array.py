"""Suffix-array dedup: repeated word passages by a sparse suffix array.

Of all word suffixes of the corpus, those at minimisers are retained: positions
whose k-gram hash is the smallest of a window.  A passage of MIN_WORDS words
holds a retained suffix within its first WINDOW words, at the same place in every
copy.  The suffixes are sorted by their first DEPTH words and neighbours compared;
those that agree across documents are extended left and right to every passage
of MIN_WORDS words that starts at most WINDOW - 1 words before and is anchored there,
and these are sorted and compared again.  Adjacent repeated passages merge
into spans.  The result is exact up to collisions of 64-bit hashes: a word is
covered if and only if it lies in a passage of MIN_WORDS words that another
document has as well.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from usagelake.llm.common import arrow_limits, slices, staged, utf8
from usagelake.llm.neighbours import neighbours
from usagelake.llm.words import hash_spans, minimisers, smallest, split_words, window_hashes

MIN_WORDS = 50
GRAM = 8
WINDOW = 26
DEPTH = MIN_WORDS - WINDOW + 1


def _documents(batch: pa.RecordBatch, column: int):
    """Word hashes of every document of a batch: its row and hashes."""
    buf, off = utf8(batch.column(column))
    for i, j in slices(off):
        part = buf[off[i]:off[j]]
        starts, ends, first = split_words(part, off[i:j + 1] - off[i])
        h = hash_spans(part, starts, ends)
        for k in range(j - i):
            yield i + k, h[first[k]:first[k + 1]]


def _out(parts, names, kinds):
    cols = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (list(zip(*parts)) or [()] * len(names))]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(k)) for c, k in zip(cols, kinds)], names)


def suffixes(docs: DataFrame) -> DataFrame:
    """``key, doc_id, pos``: the retained suffixes, keyed by the hash of their first DEPTH words."""

    def run(batches):
        for b in batches:
            ids, parts = b.column(0).to_numpy(zero_copy_only=False), []
            for row, h in _documents(b, 1):
                if len(h) >= MIN_WORDS:
                    at = minimisers(window_hashes(h, GRAM), WINDOW)
                    at = at[at <= len(h) - DEPTH]
                    parts.append((window_hashes(h, DEPTH)[at].view(np.int64), np.full(len(at), ids[row]), at))
            yield _out(parts, ["key", "doc_id", "pos"], [np.int64] * 3)

    return docs.mapInArrow(run, "key long, doc_id long, pos long")


def passages(docs: DataFrame) -> DataFrame:
    """``key, doc_id, pos``: the passages of MIN_WORDS words anchored at the suffixes ``at`` of each document."""

    def run(batches):
        for b in batches:
            ids, parts = b.column(0).to_numpy(zero_copy_only=False), []
            marks = b.column(2)
            for row, h in _documents(b, 1):
                n = len(h) - MIN_WORDS + 1
                if n <= 0:
                    continue
                live = np.zeros(len(h), bool)
                marked = marks[row].values.to_numpy(zero_copy_only=False)
                live[marked[marked < len(h)]] = True
                # a passage is anchored at the minimiser of its first WINDOW k-grams
                start = np.flatnonzero(live[smallest(window_hashes(h, GRAM), WINDOW)[:n]])
                key = window_hashes(h, MIN_WORDS)[start].view(np.int64)
                parts.append((key, np.full(len(start), ids[row]), start))
                if sum(len(p[0]) for p in parts) > 1 << 19:
                    yield _out(parts, ["key", "doc_id", "pos"], [np.int64] * 3)
                    parts = []
            yield _out(parts, ["key", "doc_id", "pos"], [np.int64] * 3)

    return docs.mapInArrow(run, "key long, doc_id long, pos long")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, start_word, end_word, first_doc_id, first_word`` of every repeated span.

    A span's words equal those of ``first_doc_id`` from ``first_word`` on: the smallest
    document (and place) that has them, which lists itself.  Words are runs of bytes
    other than ASCII white space; case and punctuation count.  Null, empty and
    short texts have no spans; rows of one doc_id are one document; rows without a
    doc_id are left out; passages repeated inside one document only are no repeats.
    """
    arrow_limits(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(
        "doc_id is not null")
    kept = staged(suffixes(texts), "suffixes")
    agree = neighbours(kept, "suffix-runs")
    # a document's anchors: bounded by its own words
    anchors = agree.groupBy("doc_id").agg(F.collect_list("pos").alias("at"))
    windows = staged(passages(texts.join(anchors, "doc_id").select("doc_id", "text", "at")), "passages")
    same = neighbours(windows, "passage-runs").select(
        "doc_id", "pos", "first_doc", (F.col("first_pos") - F.col("pos")).alias("shift")).distinct()
    place = F.row_number().over(Window.partitionBy("doc_id", "first_doc", "shift").orderBy("pos"))
    return same.withColumn("island", F.col("pos") - place).groupBy("doc_id", "first_doc", "shift", "island").agg(
        F.min("pos").alias("start_word"), (F.max("pos") + MIN_WORDS).alias("end_word")).select(
            "doc_id", "start_word", "end_word", F.col("first_doc").alias("first_doc_id"),
            (F.col("start_word") + F.col("shift")).alias("first_word"))


def without_repeats(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with every repeated span cut but in the document that has it first.

    Rows that share a doc_id stay whole: their spans don't tell which of the rows they lie in.
    """
    shared = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    cuts = spans.where("doc_id <> first_doc_id").join(shared, "doc_id", "left_anti").groupBy("doc_id").agg(
        F.collect_list(F.struct("start_word", "end_word")).alias("_cuts"))
    names, at = docs.columns, docs.columns.index("text")
    joined = docs.join(cuts, "doc_id", "left").select(*names, "_cuts")

    def run(batches):
        for b in batches:
            text = b.column(at).to_pylist()
            for row, cut in enumerate(b.column(len(names)).to_pylist()):
                if cut:
                    raw = text[row].encode()
                    starts, ends, _ = split_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
                    out, done = [], 0
                    for c in sorted((c["start_word"], c["end_word"]) for c in cut):
                        lo, hi = int(starts[c[0]]), int(ends[c[1] - 1])
                        out.append(raw[done:max(lo, done)])
                        done = max(done, hi)
                    text[row] = b"".join([*out, raw[done:]]).decode()
            cols = [*b.columns[:len(names)]]
            cols[at] = pa.array(text, b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(cols, names)

    return joined.mapInArrow(run, docs.schema)


def op1(docs: DataFrame) -> DataFrame:
    return repeated_spans(docs)
