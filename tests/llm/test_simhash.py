import numpy as np
import pytest
from xxhash import xxh64_intdigest

from usagelake.llm import simhash


def plain(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    count = [0] * 64
    for s in shingles:
        h = xxh64_intdigest(s, 42)
        for i in range(64):
            count[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * count[i] > len(shingles))


def classes(fps):
    ids, v = list(fps), np.array(list(fps.values()), np.uint64)
    low = {k: k for k in ids}
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(ids):
            for j in np.flatnonzero(np.bitwise_count(v ^ v[i]) <= 3):
                m = min(low[a], low[ids[j]])
                if low[a] != m or low[ids[j]] != m:
                    low[a] = low[ids[j]] = m
                    changed = True
    return low


def test_equals_brute_force(documents):
    got = {r.doc_id: r for r in simhash.op7(documents).collect()}
    fps = {r.doc_id: plain(r.text) for r in documents.select("doc_id", "text").collect()}
    assert {k: r.fingerprint for k, r in got.items()} == {k: f"{v:016x}" for k, v in fps.items()}
    assert {k: r.component_id for k, r in got.items()} == classes(fps)


@pytest.mark.parametrize("block", [4, 64])
def test_links_of_dense_cells_in_blocks(spark, block):
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    fps = {}
    for i in range(240):
        f = int(seeds[i % 6])
        for b in rng.integers(0, 64, rng.integers(0, 5)):
            f ^= 1 << int(b)
        fps[i] = f
    heads = {}
    for k, f in fps.items():
        heads.setdefault(f, k)
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    table = spark.createDataFrame([(signed(f), k) for f, k in heads.items()], "fp long, head long")
    edges = [(r.a, r.b) for r in simhash.grid_links(table, 3, block).collect()]
    by_fp = {signed(f): k for f, k in heads.items()}
    low = {k: k for k in heads.values()}
    for _ in range(len(low)):
        for a, b in edges:
            a, b = by_fp[a], by_fp[b]
            low[a] = low[b] = min(low[a], low[b])
    want = classes({k: f for f, k in heads.items()})
    assert low == want


def test_odd_rows(odd, empty):
    got = simhash.op7(odd).collect()
    assert len(got) == odd.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert {r.component_id for k in (1, 2, 3) for r in by[k]} == {1}
    assert {r.fingerprint for k in (1, 2, 3) for r in by[k]} == {"0" * 16}
    assert [r.component_id for r in by[5] + by[6]] == [5, 5, 5]
    assert simhash.op7(empty).collect() == []


def test_one_document_of_each_class_stays(spark, documents, odd, tmp_path):
    path = str(tmp_path / "docs")
    odd.write.parquet(path)
    written = spark.read.parquet(path)
    kept = simhash.deduplicated(written)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 4, 5, 7, 8]
    got = {r.doc_id for r in simhash.deduplicated(documents).collect()}
    assert got == {r.doc_id for r in simhash.op7(documents).where("doc_id = component_id").collect()}


def test_rows_that_stay_do_not_depend_on_file_splits(spark, tmp_path):
    rng = np.random.default_rng(8)
    texts = [" ".join(f"u{w}" for w in rng.integers(0, 10_000, 30)) for _ in range(40)]
    path = str(tmp_path / "docs")
    spark.createDataFrame([(i, texts[i % 40]) for i in range(60)], "doc_id long, text string").repartition(
        3, "doc_id").write.parquet(path)
    kept = simhash.deduplicated(spark.read.parquet(path))
    spark.conf.set("spark.sql.files.minPartitionNum", "1")  # all files in one partition from here on
    try:
        assert sorted(r.doc_id for r in kept.collect()) == list(range(40))
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
