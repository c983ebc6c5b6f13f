import random

from usagelake.llm.components import components


def test_components_equal_union_find(spark):
    rng = random.Random(0)
    edges = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(110)]
    edges += [(1000 + i, 1001 + i) for i in range(70)] + [(5, 5), (7, None)] + [(2000, 2000 + i) for i in range(1, 200)]
    low = {}

    def find(x):
        while low.setdefault(x, x) != x:
            x = low[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            a, b = find(a), find(b)
            low[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in low}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
