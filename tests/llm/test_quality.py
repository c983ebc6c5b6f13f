import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from usagelake.llm import quality, words as words_module

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = quality.op4(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert all(zlib.crc32(str(i).encode()) % 5 == 0 for i in out["doc_id"])
    assert (out["predicted"] == out["quality"]).mean() > 0.98
    assert out[out["quality"] == 1]["predicted"].mean() > 0.99
    assert out[out["quality"] == 0]["predicted"].mean() < 0.1


def test_held_out_labels_and_other_columns_do_not_matter(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    base = {r.doc_id: r.score for r in quality.op4(docs, labels).collect()}
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0,
                                                  1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("s")).repartition(5)
    assert {r.doc_id: r.score for r in quality.op4(other, flipped).collect()} == pytest.approx(base)


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 0), (7, None, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.op4(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    blank = {r.score for r in got if r.doc_id in (1, 2, 3)}
    assert len(blank) == 1
    assert quality.op4(empty, labels).collect() == []
    none = quality.op4(odd, labels.where("false")).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 1)}
    assert quality.accepted(odd, labels.where("false")).columns == odd.columns
    assert quality.accepted(odd, labels.where("false")).exceptAll(odd).count() == 0


def test_words_shapes_and_repeats_count_by_ones_twos_and_threes():
    texts = [b"one two three four", b"a b", b"", b"x"]
    buf = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    assert quality.features(buf, offsets)[2].tolist() == [3 * (4 + 3 + 2), 3 * (2 + 1), 0, 3]


def _plain_features(text, bits):
    """Buckets of one document, n-gram by n-gram."""
    low = text.lower().split()
    shape = ["".join(c for c, d in zip(k, " " + k) if c != d) for k in
             ("".join("X" if c.isupper() else "9" if c.isdigit() else "x" for c in w) for w in text.split())]

    def hashed(words):
        buf = np.frombuffer("".join(words).encode(), np.uint8)
        end = np.cumsum([len(w) for w in words], dtype=np.int64)
        return words_module.hash_spans(buf, end - [len(w) for w in words], end)

    again = [np.uint64(i > 0 and low[i] == low[i - 1]) for i in range(len(low))]
    out = []
    for salt, h in ((1, hashed(low)), (2, hashed(shape)), (3, again)) if low else ():
        for size in (1, 2, 3):
            for i in range(len(h) - size + 1):
                g = np.full(1, salt * 16 + size, np.uint64)
                for x in h[i:i + size]:
                    g = words_module.mix(g + x)
                out.append(int(g[0] >> np.uint64(64 - bits)))
    return sorted(out)


def test_features_and_scores_equal_a_plain_version_and_ignore_neighbours(spark):
    """Documents that begin with the last word of the one before get the features they have alone."""
    texts = ["One two TWO 3x3 two", "two two three", "three", "", "three one", "one", "\t one one  one ", "x" * 300 + " Ab"]
    buf = np.frombuffer("".join(texts).encode(), np.uint8)
    bucket, doc, count = quality.features(buf, np.cumsum([0, *map(len, texts)]))
    for d, text in enumerate(texts):
        want = _plain_features(text, quality.BITS)
        assert sorted(bucket[doc == d].tolist()) == want and count[d] == len(want)
    rows = [(i, t) for i, t in enumerate(texts * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(16)], "doc_id long, quality int, toxic int")
    seen = []
    for table in (docs.coalesce(1), docs.repartition(16, "doc_id"), docs.orderBy("text").coalesce(1)):
        seen.append({r.doc_id: r.score for r in quality.op4(table, labels).collect()})
    assert seen[0] == seen[1] == seen[2]
    assert all(seen[0][i] == seen[0][i + 8] for i in range(8))
