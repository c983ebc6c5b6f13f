import random

import numpy as np

from usagelake.llm import chaining


def test_near_copies_beside_an_equal_run_are_all_found(spark, monkeypatch):
    """Documents with an equal run in common; another passage of theirs is edited in half of them, and no equal run joins the halves there."""
    monkeypatch.setattr(chaining, "RARE", 6)
    rng = random.Random(12)
    text = lambda n: [f"u{rng.getrandbits(50)}" for _ in range(n)]
    common, one, two, near = text(70), text(60), text(60), text(66)
    edited = [w if i % 6 != 5 else f"e{i}" for i, w in enumerate(near)]
    docs = {k: text(20) + common + (one + near if k < 8 else two + edited) + text(9) for k in range(16)}
    table = spark.createDataFrame([(k, " ".join(w)) for k, w in docs.items()], "doc_id long, text string")
    got = {(r.doc_id, r.other_id, r.start_word, r.end_word) for r in chaining.op5(table).collect()}
    equal = {(k, 0, 20, 216) for k in range(1, 8)} | {(8, 0, 20, 90)} | {(k, 8, 20, 216) for k in range(9, 16)}
    assert {r[:2] for r in got if r[2] == 150} == {(b, a) for a in range(8) for b in range(8, 16)}
    assert equal <= got and {r[:2] for r in got if r[2] != 150} == {r[:2] for r in equal} | {(k, 0) for k in range(9, 16)}


def test_the_most_shared_run_around_a_seed():
    rng = np.random.default_rng(14)
    for _ in range(40):
        begin = np.unique(rng.integers(0, 150, rng.integers(0, 60)))
        n, key = rng.integers(2, 5, len(begin)), rng.permutation(len(begin)) - 20
        pos = np.sort(rng.integers(0, 220, rng.integers(1, 30)))
        for p, k in zip(pos, chaining._most_shared(pos, begin, n, key)):
            around = [i for i, b in enumerate(begin) if p - 46 <= b <= p]
            assert k == max(around, key=lambda i: (n[i], key[i]), default=-1)
