import random

import numpy as np
import pyarrow as pa

from usagelake.llm import chaining


def _asked(rows):
    names = ["chain", "a0", "a1", "doc_b", "b0", "b1"]
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)


def test_words_of_several_chains_are_sent_once():
    """A text that repeats words has chains at all its places with the same other document."""
    h = np.arange(500, dtype=np.uint64) << np.uint64(20)
    rows = [(i, i, i + 4, 7, 3, 7) for i in range(100, 300)] + [(1000, 2, 30, 9, 0, 28), (1001, 450, 480, 9, 0, 30), (1002, 490, 520, 9, 0, 30)]
    random.Random(1).shuffle(rows)
    for kind in (np.uint16, np.uint64):
        sent = {other: (np.frombuffer(c, np.int64).reshape(-1, 9), np.frombuffer(w, kind)) for other, doc, c, w in
                chaining._send(5, h, _asked(rows), 64, kind) if doc == 5}
        assert {k: len(w) for k, (_, w) in sent.items()} == {7: 303 + 64 - 36, 9: 94 + 500 - 386}
        assert sum(len(c) for c, _ in sent.values()) == len(rows) - 1  # one chain ends after the text
        for c, w in sent.values():
            for chain, a0, a1, _, _, low, at, size, after in c.tolist():
                assert (low, low + size, after) == (max(0, a0 - 64), min(500, a1 + 64), 500 - min(500, a1 + 64))
                assert (w[at:at + size] == h[low:low + size].astype(kind)).all()


def test_packed_links_come_back_in_buckets():
    rng = np.random.default_rng(2)
    links = [rng.integers(0, 1 << 40, 5000), rng.integers(0, 1 << 40, 5000), rng.integers(0, 1 << 30, 5000),
             rng.integers(0, 1 << 30, 5000), rng.integers(0, 200, 5000)]
    packed = chaining._pack([c.copy() for c in links], 30)
    assert sorted(packed["bucket"].to_pylist()) == list(range(30))
    for bucket, row in zip(packed["bucket"].to_pylist(), packed["packed"].to_pylist()):
        a, b, *_ = chaining._unpack([row])
        assert (chaining._bucket(a, b, 30) == bucket).all()
    got = chaining._unpack(packed["packed"].to_pylist())
    links[4] = np.minimum(links[4], chaining.MIN_SEEDS)
    assert sorted(zip(*(c.tolist() for c in got))) == sorted(zip(*(c.tolist() for c in links)))


def test_chains_of_rising_anchors_equal_those_of_the_tree():
    """Anchors that rise in both texts need no tree; one more anchor far off makes it the general case."""
    rng = np.random.default_rng(4)
    for _ in range(50):
        n = int(rng.integers(2, 40))
        x, y = (np.cumsum(rng.integers(1, 60, n)) + 10 for _ in "xy")
        far = np.append(x, 10 ** 7), np.append(y, 1)
        got = sorted(map(tuple, chaining.chains(x, y, 1)))
        assert got == sorted(tuple(p) for p in chaining.chains(*far, 1) if n not in p)


def test_shares_and_passes_change_no_row(spark, monkeypatch):
    rng = random.Random(3)
    text = lambda n: [f"v{rng.randint(0, 3000)}" for _ in range(n)]
    p = text(90)
    docs = [(k, " ".join(text(20) + [w if (i + k) % 11 else f"e{k}" for i, w in enumerate(p)] + ["on"] * (9 * k) + text(20)))
            for k in range(12)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    want = sorted(map(tuple, chaining.op5(table).collect()))
    for name, value in (("LINKS", 500), ("BUCKET_LINKS", 100), ("SHARE", 5000), ("SENT", 300)):
        monkeypatch.setattr(chaining, name, value)
    assert len(want) >= 66 and sorted(map(tuple, chaining.op5(table).collect())) == want
