import zlib

from pyspark.sql import functions as F

from usagelake.llm import sharding


def test_law_slots_and_groups(documents):
    rows = documents.collect()
    got = {r.doc_id: r for r in sharding.op3(documents).collect()}
    assert len(got) == len(rows)
    load, slots, groups = [0] * 40, {}, {}
    for r in rows:
        g = got[r.doc_id]
        raw = (r.text or "").encode()
        assert (g["size"], g.text_crc32, g.law, g.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        load[g.shard] += g["size"]
        slots.setdefault(g.shard, []).append(g.slot)
        groups.setdefault(r.text, set()).add(g.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(load) - min(load) <= max(g["size"] for g in got.values())


def test_bytes_are_near_equal(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = sharding.sharded(docs).groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n"),
                                                      F.sum("tokens").alias("t")).toPandas()
    assert len(got) == 40 and got["b"].max() / got["b"].min() < 1.01
    assert got["n"].max() / got["n"].min() < 1.15 and got["t"].max() / got["t"].min() < 1.15
    again = sharding.sharded(docs.repartition(7)).select("doc_id", "shard", "slot")
    assert again.exceptAll(sharding.sharded(docs).select("doc_id", "shard", "slot")).count() == 0


def test_groups_stay_together_and_hot_groups_are_cut(spark):
    rows = [(i, f"text {i // 2} " + "y" * (i % 50)) for i in range(0, 4000)] + [(i, "the same text") for i in range(4000, 6000)]
    docs = spark.createDataFrame([(i, t if i >= 4000 else f"pair {i // 2}") for i, t in rows], "doc_id long, text string")
    got = sharding.sharded(docs, 8).join(docs, "doc_id")
    split = got.groupBy("text").agg(F.countDistinct("shard").alias("s")).collect()
    assert all(r.s == (8 if r.text == "the same text" else 1) for r in split)
    load = [r.b for r in got.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert max(load) / min(load) < 1.02


def test_odd_rows(odd, empty):
    got = sharding.op3(odd).collect()
    assert len(got) == odd.count()
    assert {r["size"] for r in got if r.doc_id in (1, 2)} == {16}
    assert sharding.op3(empty).collect() == []
