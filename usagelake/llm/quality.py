"""Quality classifier: hashed word n-gram logistic regression, trained by FTRL-proximal.

A document is seen as three sequences: its words (A-Z lower-cased), the shapes
of its words (runs of the same character class written once) and whether each
word repeats the one before.  Hashed n-grams of all three fill one weight space; a feature's value is its share of the
document's n-grams, so a score is a sparse dot product of counts and weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from usagelake.llm.common import arrow_limits, fresh, slices, utf8
from usagelake.llm.words import hash_spans, mix, split_words

BITS = 18
SAMPLE_ROWS = 8192
EPOCHS = 4
SCALE = 8.0
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.5
THRESHOLD = 0.3

# character classes of the shape view: a-z and all non-ASCII bytes, A-Z, 0-9;
# other bytes stand for themselves
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123] = ord("x")
_CLASS[128:] = ord("x")
_CLASS[65:91] = ord("X")
_CLASS[48:58] = ord("9")


def _ngrams(h: np.ndarray, first: np.ndarray, sizes: tuple[int, ...], salt: int, bits: int):
    """Bucket ids of all n-grams and the document of each, for word hashes ``h``."""
    n = len(h)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for size in sizes:
        if n < size:
            continue
        m = n - size + 1
        g = np.full(m, np.uint64(salt * 16 + size))
        for i in range(size):
            g = mix(g + h[i:i + m])
        inside = doc[:m] == doc[size - 1:]
        yield (g[inside] >> np.uint64(64 - bits)).astype(np.int64), doc[:m][inside]


def features(buf: np.ndarray, offsets: np.ndarray, bits: int = BITS):
    """Hashed n-grams of the documents in ``buf``: bucket and document of each, plus each document's count."""
    starts, ends, first = split_words(buf, offsets)
    words = hash_spans(_LOWER[buf], starts, ends)
    cls = _CLASS[buf]
    fresh = np.ones(len(buf), bool)
    fresh[1:] = cls[1:] != cls[:-1]
    fresh[starts] = True
    at = np.concatenate(([0], np.cumsum(fresh)))
    shapes = hash_spans(cls[fresh], at[starts], at[ends])
    again = np.zeros(len(words), np.uint64)
    again[1:] = words[1:] == words[:-1]
    again[first[:-1][first[:-1] < len(words)]] = 0  # a document's first word repeats nothing
    parts = [*_ngrams(words, first, (1, 2, 3), 1, bits), *_ngrams(shapes, first, (1, 2, 3), 2, bits),
             *_ngrams(again, first, (1, 2, 3), 3, bits)]
    bucket = np.concatenate([p[0] for p in parts] or [np.zeros(0, np.int64)])
    doc = np.concatenate([p[1] for p in parts] or [np.zeros(0, np.int64)])
    return bucket, doc, np.bincount(doc, minlength=len(offsets) - 1)


def _sparse_rows(docs: DataFrame, bits: int) -> DataFrame:
    """``key, label, idx, val``: the training rows as sparse vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, off = utf8(b.column(2))
            for i, j in slices(off):
                bucket, doc, n = features(buf[off[i]:off[j]], off[i:j + 1] - off[i], bits)
                pair, count = np.unique(doc << bits | bucket, return_counts=True)
                row = pair >> bits
                cut = np.searchsorted(row, np.arange(j - i + 1))
                val = count / np.maximum(n, 1)[row] * SCALE
                lists = pa.array(cut.astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(i, j - i), b.column(1).slice(i, j - i),
                    pa.ListArray.from_arrays(lists, pa.array((pair & ((1 << bits) - 1)).astype(np.int32))),
                    pa.ListArray.from_arrays(lists, pa.array(val.astype(np.float32)))],
                    ["key", "label", "idx", "val"])

    return docs.select("key", "label", "text").mapInArrow(
        run, "key string, label int, idx array<int>, val array<float>")


def ftrl(rows, bits: int = BITS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (the last entry is the bias) from ``(idx, val, label)`` rows by FTRL-proximal updates."""
    size = (1 << bits) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    bias, one = np.array([size - 1], np.int32), np.ones(1, np.float32)
    rows = [(np.concatenate((i, bias)), np.concatenate((v, one)), y) for i, v, y in rows]
    for _ in range(epochs):
        for i, v, y in rows:
            w = weights(i)
            p = 1 / (1 + np.exp(-np.clip(w @ v, -35, 35)))
            g = (p - y) * v
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - sigma * w
            n[i] += g * g
    return weights(np.arange(size)).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", bits: int = BITS,
          sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Fit on at most ``sample_rows`` labelled rows outside the held-out fold.

    The sample holds the smallest md5(doc_id), so it is the same for any partitioning.
    Rows whose crc32(doc_id as text) mod 5 is 0, and null or other labels, are not read.
    The broadcast and the fitting task are bounded by ``sample_rows``.  Without a
    labelled row all weights are 0.
    """
    arrow_limits(docs.sparkSession)
    ident = F.col("doc_id").cast("string")
    picked = (labels.where(F.col(label).isin(0, 1) & (F.crc32(ident) % 5 != 0))
              .select("doc_id", F.col(label).cast("int").alias("label"), F.md5(ident).alias("key"))
              .orderBy("key", "label").limit(sample_rows))
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    vectors = _sparse_rows(rows, bits).orderBy("key", "label").limit(sample_rows)

    def fit(batches):
        def rows():  # a row's arrays are read from its batch, which then goes
            for b in batches:
                y = b.column("label").to_numpy(zero_copy_only=False)
                for k in range(b.num_rows):
                    yield b.column("idx")[k].values.to_numpy(), b.column("val")[k].values.to_numpy(), int(y[k])

        yield pa.RecordBatch.from_arrays([pa.array([ftrl(rows(), bits).tobytes()], pa.binary())], ["w"])

    model = vectors.coalesce(1).mapInArrow(fit, "w binary").first()
    return np.frombuffer(bytes(model["w"]), np.float32)


def scored(docs: DataFrame, weights: np.ndarray, bits: int = BITS, column: str = "_score") -> DataFrame:
    """All columns of ``docs`` plus ``column`` (double, 0 to 1); weights are a fixed-size broadcast."""
    spark = docs.sparkSession
    arrow_limits(spark)
    model = spark.sparkContext.broadcast(weights)
    names = docs.columns
    schema = StructType([*docs.schema.fields, StructField(column, DoubleType())])
    at = names.index("text")

    def run(batches):
        w = model.value.astype(np.float64)
        for b in batches:
            buf, off = utf8(b.column(at))
            parts = []
            for i, j in slices(off):
                bucket, doc, n = features(buf[off[i]:off[j]], off[i:j + 1] - off[i], bits)
                total = np.bincount(doc, weights=w[bucket], minlength=j - i)
                parts.append(1 / (1 + np.exp(-np.clip(total / np.maximum(n, 1) * SCALE + w[-1], -35, 35))))
            score = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score)], [*names, column])

    return docs.mapInArrow(run, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", column: str = "_score") -> DataFrame:
    """Train on ``labels`` and score every whole text of ``docs``; columns of ``docs`` stay.

    Null and empty texts score the bias alone; repeated rows score alike; an empty
    ``docs`` gives no rows; without usable labels every score is 0.5.
    """
    return scored(docs, train(docs, labels, label), column=column)


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` that score at least THRESHOLD, with their columns unchanged."""
    column = fresh(docs, "_score")
    return quality_scores(docs, labels, column=column).where(F.col(column) >= THRESHOLD).drop(column)


def op4(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns."""
    return quality_scores(docs.select("doc_id", "text"), labels.select("doc_id", "quality")).select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"),
        F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))
