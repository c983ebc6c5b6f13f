import numpy as np
import pytest
from pyspark.sql import functions as F

from usagelake.llm import cover_tree, topk

VECTORS = "vec_id long, embedding array<float>, label int"


def clustered(n=700, dims=24, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    spread = rng.choice([0.01, 0.05, 0.15, 0.25, 1.0], 12)
    pick = rng.integers(0, 12, n)
    x = (centres[pick] + spread[pick][:, None] * rng.normal(size=(n, dims))).astype(np.float32)
    x[n // 2:n // 2 + 40] = x[0]
    return x


def brute(x, threshold=0.95):
    x = x.astype(float)
    norm = np.sqrt((x * x).sum(1))
    link = (x @ x.T) / (norm[:, None] * norm[None]) >= threshold
    np.fill_diagonal(link, False)
    low = np.arange(len(x))
    while True:
        new = np.array([min(low[i], low[link[i]].min(initial=low[i])) for i in range(len(x))])
        if (new == low).all():
            return link.sum(1), low
        low = new


@pytest.mark.parametrize("block", [100, 4096])
def test_cover_tree_equals_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(cover_tree.threshold_links, "__defaults__", (block,))
    x = clustered()
    table = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(x)], VECTORS)
    got = {r.vec_id: r for r in cover_tree.op9(table).collect()}
    links, low = brute(x)
    assert [got[i].n_links for i in range(len(x))] == links.tolist()
    assert [got[i].component_id for i in range(len(x))] == low.tolist()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert links.max() > 40


def test_cover_tree_is_nested_with_halving_radii():
    x = cover_tree._unit(clustered(400).astype(float))
    t = cover_tree.Tree(x)

    def walk(node, level):
        inside = t.order[t.lo[node]:t.hi[node]]
        d = cover_tree._distances(x[t.centre[node]][None], x[inside]).max()
        assert d <= t.radius[node] + 1e-6
        if level <= len(cover_tree.RADII):
            assert d <= cover_tree.RADII[level - 1] + 1e-6
        if t.kids[node] is not None:
            centres = [t.centre[k] for k in t.kids[node]]
            assert t.centre[node] in centres
            assert sum(t.hi[k] - t.lo[k] for k in t.kids[node]) == len(inside)
            for k in t.kids[node]:
                walk(k, level + 1)

    for r in t.roots:
        walk(int(r), 1)


def test_cover_tree_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, []), (9, [0.0, 1.0]), (10, [1.0, 0.0, 0.0]), (None, [0.0, 1.0])]
    table = spark.createDataFrame([(i, v, 0, "c") for i, v in rows], VECTORS + ", point string")
    got = sorted(((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in cover_tree.op9(table).collect()))
    assert got == [(0, 1, 9, False), (1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False)] + [
        (i, 0, i, True) for i in (3, 4, 5, 6, 7, 8)] + [(9, 1, 9, True), (10, 0, 10, True)]
    assert cover_tree.op9(table.where("false")).collect() == []
    assert cover_tree.op9(table.where("vec_id = 3")).collect()[0].n_links == 0


def plain_top(codes, queries, k):
    out = []
    for q, c in sorted(set(queries)):
        order = sorted((bin((c ^ d) & (1 << 64) - 1).count("1"), i) for i, d in codes if i != q)
        out += [(q, n + 1, i, d) for n, (d, i) in enumerate(order[:k])]
    return sorted(out)


@pytest.mark.parametrize("kind", ["random", "clustered", "copies", "few", "rows of one id", "ids of many codes"])
def test_top_k_equals_brute_force(spark, kind):
    rng = np.random.default_rng(7)
    base = rng.integers(-(1 << 63), 1 << 63, 300, dtype=np.int64)
    if kind == "clustered":
        base = base[:5][rng.integers(0, 5, 300)] ^ (np.int64(1) << rng.integers(0, 63, 300))
    if kind == "copies":
        base[50:200] = base[0]
    if kind == "few":
        base = base[:6]
    codes = [(i, int(c)) for i, c in enumerate(base)]
    if kind == "rows of one id":  # an id with more rows than an answer has, of one code and of its neighbours
        codes = [(50, int(base[0]))] * 15 + [(51, int(base[0])), (52, int(base[0])), (53, int(base[1]))]
        codes += [(54, int(base[0]) ^ 1)] * 12 + codes[-1:] * 3
    if kind == "ids of many codes":
        codes = [(i % 7, int(base[0]) ^ (1 << i % 60)) for i in range(200)] + codes[1:12]
    queries = sorted(set(codes)) if kind in ("rows of one id", "ids of many codes") else codes[::25] if kind != "few" else codes
    got = topk.top_k(spark.createDataFrame(codes, "id long, code long"), spark.createDataFrame(queries, "id long, code long"))
    assert sorted((r.query_id, r.rank, r.id, r.distance) for r in got.collect()) == plain_top(codes, queries, topk.K)


def test_top_k_odd_rows(spark):
    rows = [(0, [1.0] * 64), (0, [1.0] * 64), (1, None), (2, []), (50, [None, float("nan")] + [1.0] * 62), (None, [1.0] * 64)]
    table = spark.createDataFrame([(i, v, 0, 1) for i, v in rows], VECTORS + ", code int")
    got = [(r.query_id, r.rank, r.id, r.distance) for r in topk.op10(table).collect()]
    assert (50, 1, 0, 2) in got and (50, 2, 0, 2) in got and (50, 3, 2, 62) in got
    assert {g[1] for g in got if g[0] == 0} == {1, 2}
    assert topk.op10(table.where("false")).collect() == []
    codes = {r.id: r.code for r in topk.sign_codes(table.where("vec_id is not null")).collect()}
    assert codes[0] == -1 and codes[2] == 0 and F.col("x") is not None


def test_cover_tree_of_very_small_and_large_doubles(spark):
    """Only directions count, also where squares over- or underflow."""
    rows = [(0, [1e-200, 2e-200]), (1, [1.0, 0.01]), (2, [1e200, 2e200]), (3, [3e200, 6e200]), (4, [5e-324, 1e-323]),
            (5, [1.0, 2.0]), (6, [1.7e308, 0.0]), (7, [1e-300, 1e-302])]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in cover_tree.op9(table).collect()}
    assert got == {**{i: (4, 0) for i in (0, 2, 3, 4, 5)}, **{i: (2, 1) for i in (1, 6, 7)}}
