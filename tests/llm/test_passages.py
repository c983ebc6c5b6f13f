import random
import re

import numpy as np
import pytest

from usagelake.llm import chaining, neighbours, suffix_array
from usagelake.llm.words import hash_spans, minimisers, split_words, window_hashes


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def covered(texts, size=50):
    """Word places in passages that another document has as well."""
    held = {}
    for k, w in texts.items():
        for i in range(len(w) - size + 1):
            held.setdefault(tuple(w[i:i + size]), set()).add(k)
    return {(k, j) for k, w in texts.items() for i in range(len(w) - size + 1)
            if len(held[tuple(w[i:i + size])]) > 1 for j in range(i, i + size)}


def corpus(seed=1):
    """Documents with copies, planted passages of 49 to 120 words, low-variety and edited texts."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    planted = {n: text(n) for n in (49, 50, 51, 75, 120)}
    docs = {}
    for i in range(60):
        w = text(rng.randint(0, 150))
        if i % 3 == 0:
            w[len(w) // 2:len(w) // 2] = planted[rng.choice(list(planted))]
        if i % 7 == 0:
            w += ["same"] * rng.randint(40, 130)
        docs[i] = w
    docs[60] = docs[61] = text(90)
    docs[62] = docs[60][:40] + ["edit"] + docs[60][40:]
    docs[63] = planted[120][20:80] + text(10) + planted[120][60:]
    return docs


def test_word_hashes_and_minimisers():
    raw = " a bb\tccc\x0b\n d\x0c e é  bb".encode()
    buf = np.frombuffer(raw, np.uint8)
    starts, ends, first = split_words(buf, np.array([0, 7, 7, len(raw)]))
    assert [raw[s:e] for s, e in zip(starts, ends)] == words(" a bb\tc") + words(raw[7:].decode())
    h = hash_spans(buf, starts, ends)
    assert h[1] == h[-1] and len(set(h.tolist())) == len(h) - 1
    x = np.random.default_rng(0).integers(0, 50, 500).astype(np.uint64)
    for w in (1, 2, 7, 26):
        assert minimisers(x, w).tolist() == sorted({i + int(x[i:i + w].argmin()) for i in range(len(x) - w + 1)})
    for size in (5, 25):
        g = window_hashes(x, size)
        assert len({tuple(x[i:i + size]) for i in range(len(g))}) == len(set(g.tolist()))


def test_repeated_spans_are_exact(spark):
    docs = corpus()
    table = spark.createDataFrame([(k, " ".join(w)) for k, w in docs.items()], "doc_id long, text string")
    got = suffix_array.op1(table).collect()
    texts = {k: [x.encode() for x in w] for k, w in docs.items()}
    assert {(r.doc_id, j) for r in got for j in range(r.start_word, r.end_word)} == covered(texts)
    for r in got:
        n = r.end_word - r.start_word
        assert n >= 50
        assert texts[r.doc_id][r.start_word:r.end_word] == texts[r.first_doc_id][r.first_word:r.first_word + n]


def test_repeated_spans_of_given_documents(documents):
    got = suffix_array.op1(documents).collect()
    texts = {r.doc_id: words(r.text) for r in documents.collect()}
    assert {(r.doc_id, j) for r in got for j in range(r.start_word, r.end_word)} == covered(texts)


def test_cut_of_repeats(spark):
    docs = corpus()
    table = spark.createDataFrame([(k, " ".join(w), "en") for k, w in docs.items()], "doc_id long, text string, lang string")
    out = suffix_array.without_repeats(table, suffix_array.op1(table))
    assert out.columns == table.columns
    left = {r.doc_id: words(r.text) for r in out.collect()}
    assert left[60] == [x.encode() for x in docs[60]] and left[61] == []
    assert not covered(left)


def test_cut_leaves_rows_of_a_shared_doc_id_whole(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(1, passage), (2, "a b " + passage), (2, "short"), (3, passage + " c"), (4, None), (None, passage)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    out = suffix_array.without_repeats(table, suffix_array.op1(table)).collect()
    want = [(1, passage), (2, "a b " + passage), (2, "short"), (3, " c"), (4, None), (None, passage)]
    assert sorted(map(tuple, out), key=repr) == sorted(want, key=repr)


def test_runs_over_partition_ends(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "ROWS_PER_PARTITION", 40)
    rng = random.Random(4)
    rows = [(rng.choice([1, 1, 1, 2, 3]) if i % 2 else i, rng.randint(0, 120), rng.randint(0, 5)) for i in range(600)]
    got = {(r.key, r.doc_id, r.pos): r for r in neighbours.neighbours(
        spark.createDataFrame(rows, "key long, doc_id long, pos long"), "t").collect()}
    for key in {r[0] for r in rows}:
        mine = sorted({r[1:] for r in rows if r[0] == key})
        many = len({d for d, _ in mine}) > 1
        for d, p in mine:
            assert ((key, d, p) in got) == many
            if many:
                r = got[key, d, p]
                assert (r.first_doc, r.first_pos) == mine[0]
                before = [x for x in mine if x[0] < d]
                assert (r.prev_doc, r.prev_pos) == (before[-1] if before else (None, None))


def test_ranks_of_occurrences():
    rows = np.array([(7, d, p) for d, ps in ((1, (0, 5, 9)), (2, (3, 4)), (3, (1, 2, 6, 8))) for p in ps])
    got = {(r["doc_id"], r["pos"]): ((r["first_doc"], r["first_pos"]), (r["prev_doc"], r["prev_pos"]))
           for r in neighbours._compare(*rows[::-1].T, 0, True).to_pylist()}
    assert got[2, 4] == ((1, 5), (1, 5)) and got[1, 9] == ((1, 9), (None, None))
    assert [got[3, p] for p in (1, 2, 6, 8)] == [((1, 0), (2, 3)), ((1, 5), (2, 4)), ((1, 9), (2, 4)), ((1, 9), (2, 4))]


def test_fuzzy_pairs_of_repetitive_texts(spark):
    line = [f"r{i}" for i in range(30)]
    docs = {1: line * 6 + ["a"] * 5, 2: ["z"] * 9 + line * 6, 3: [f"n{i}" for i in range(200)]}
    table = spark.createDataFrame([(k, " ".join(w)) for k, w in docs.items()], "doc_id long, text string")
    best = max(chaining.op5(table).collect(), key=lambda r: r.matched)
    assert (best.doc_id, best.other_id, best.matched) == (2, 1, 180)


def test_fenwick_chain_equals_plain_dynamic_programming():
    rng = np.random.default_rng(2)
    for _ in range(30):
        n = int(rng.integers(1, 60))
        x, y = rng.integers(0, 80, n), rng.integers(0, 80, n)
        score = {}
        for i in sorted(range(n), key=lambda i: (x[i], y[i])):
            gains = [score[j] - chaining.GAP_COST * (x[i] - x[j] + y[i] - y[j]) for j in score if x[j] < x[i] and y[j] < y[i]]
            score[i] = chaining.SEED_WORDS + max([0.0, *gains])
        found = chaining.chains(x, y)
        if found and len(found[0]) > 1:
            p = found[0]
            assert (np.diff(x[p]) > 0).all() and (np.diff(y[p]) > 0).all()
            got = chaining.SEED_WORDS * len(p) - chaining.GAP_COST * float(x[p[-1]] - x[p[0]] + y[p[-1]] - y[p[0]])
            assert got == pytest.approx(max(score.values()))
        used = [int(i) for p in found for i in p]
        assert len(used) == len(set(used))


def test_common_subsequence_equals_dynamic_programming():
    rng = np.random.default_rng(3)
    for _ in range(40):
        a, b = (rng.integers(0, 6, rng.integers(1, 40)) for _ in range(2))
        t = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                t[i + 1, j + 1] = t[i, j] + 1 if a[i] == b[j] else max(t[i, j + 1], t[i + 1, j])
        assert chaining._common(a, b) == t[-1, -1]


def test_fuzzy_passages(spark):
    rng = random.Random(9)
    text = lambda n: [f"v{rng.randint(0, 5000)}" for _ in range(n)]
    p = text(120)
    edited = [w if i % 17 else "EDIT" for i, w in enumerate(p)]
    docs = {1: text(30) + p + text(40), 2: text(80) + edited + text(10), 3: text(200), 4: p[:30] + text(100),
            5: [w if i % 3 else "X" for i, w in enumerate(p)], 6: p[:70] + ["inserted", "words"] + p[70:]}
    table = spark.createDataFrame([(k, " ".join(w)) for k, w in docs.items()], "doc_id long, text string")
    got = {(r.doc_id, r.other_id): r for r in chaining.op5(table).collect()}
    assert {k for pair in got for k in pair} == {1, 2, 6}
    r = got[2, 1]
    assert abs(r.start_word - 80) <= 2 and abs(r.end_word - 200) <= 2 and r.similarity > 0.9
    assert got[6, 1].end_word == 122 and got[6, 1].matched == 120


def test_passages_apart_in_one_chain(spark):
    rng = random.Random(21)
    text = lambda n: [f"q{rng.randint(0, 500)}" for _ in range(n)]
    head, foot, stray = text(60), text(60), text(7)
    docs = {1: head + text(200) + foot, 2: head + text(200) + foot,
            3: (p := text(55)) + text(30) + stray + text(90), 4: p + text(30) + stray + text(90)}
    table = spark.createDataFrame([(k, " ".join(w)) for k, w in docs.items()], "doc_id long, text string")
    got = {(r.doc_id, r.other_id, r.start_word, r.end_word, r.other_start, r.other_end) for r in chaining.op5(table).collect()}
    assert {(2, 1, 0, 60, 0, 60), (2, 1, 260, 320, 260, 320), (4, 3, 0, 55, 0, 55)} == got


def test_matches_equal_common_subsequence(monkeypatch):
    rng = np.random.default_rng(6)
    for table in (1 << 26, 50):
        monkeypatch.setattr(chaining, "TABLE_BITS", table)
        for _ in range(40):
            a, b = (rng.integers(0, 6, rng.integers(1, 60)) for _ in range(2))
            got = chaining._matches(a.tolist(), b.tolist())
            assert len(got) == chaining._common(a, b) and all(a[i] == b[j] for i, j in got)
            assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))


def test_ends_with_an_inserted_word():
    rng = np.random.default_rng(31)
    for at in (3, 10, 42, 49):
        p = rng.integers(0, 1 << 40, 52)
        a = np.concatenate((rng.integers(0, 1 << 40, 80), p, rng.integers(0, 1 << 40, 80)))
        b = np.concatenate((rng.integers(0, 1 << 40, 90), p[:at], [7], p[at:], rng.integers(0, 1 << 40, 70)))
        x = 20 if at < 26 else 10  # a chain of 20 words on the far side of the inserted one
        shift = at < 26
        hits, ends = chaining.align(a, b, 80 + x, 100 + x, 90 + x + shift, 110 + x + shift)
        assert hits == [(80, 132, 90, 143, 52)] and not any(ends)


def test_ends_far_from_a_chain(spark):
    rng = random.Random(5)
    p = [f"z{rng.randint(0, 9000)}" for _ in range(900)]
    docs = [(1, " ".join(["one"] * 5 + p)), (2, " ".join(["two"] * 9 + p[:200] + ["more"] + p[200:]))]
    texts = spark.createDataFrame(docs, "doc_id long, text string")
    found = spark.createDataFrame([(0, 1, 305, 325, 2, 310, 330)],
                                  "chain long, doc_a long, a0 long, a1 long, doc_b long, b0 long, b1 long")
    near, far = (chaining._aligned(texts, found, m).collect() for m in (chaining.MARGIN, 1000))
    assert [r.open for r in near] == [True]
    assert [tuple(r)[1:] for r in far] == [(False, 2, 9, 910, 1, 5, 905, 900)]


def test_short_passages_at_the_least_similarity(spark):
    rng = random.Random(13)
    text = lambda n: [f"m{rng.randint(0, 200_000)}" for _ in range(n)]
    docs = {}
    for k in range(0, 60, 2):
        p = text(50)
        edited = [w if i % 5 != 2 else f"e{k}x{i}" for i, w in enumerate(p)]  # 40 of 50 words
        docs[k], docs[k + 1] = text(40) + p + text(40), text(30) + edited + text(50)
    table = spark.createDataFrame([(k, " ".join(w)) for k, w in docs.items()], "doc_id long, text string")
    assert {(r.doc_id, r.other_id) for r in chaining.op5(table).collect()} == {(k + 1, k) for k in range(0, 60, 2)}


def test_thinned_anchors_keep_the_ends_of_runs():
    x = np.array([5, 0, 1, 2, 3, 9, 10, *range(20, 40), 3])
    y = np.array([9, 4, 5, 6, 7, 2, 4, *range(30, 50), 8])
    kept = {(int(x[i]), int(y[i])) for i in chaining.thinned(x, y)}
    assert kept == {(5, 9), (0, 4), (3, 7), (9, 2), (10, 4), (20, 30), (28, 38), (36, 46), (39, 49), (3, 8)}


def test_fuzzy_passages_cover_exact_ones(documents):
    exact = {r.doc_id for r in suffix_array.op1(documents).collect()}
    fuzzy = {k for r in chaining.op5(documents).collect() for k in (r.doc_id, r.other_id)}
    assert exact <= fuzzy


@pytest.mark.parametrize("op", [suffix_array.op1, chaining.op5])
def test_odd_rows(op, spark, odd, empty):
    assert op(odd).collect() == []
    assert op(empty).collect() == []
    long = odd.where("doc_id = 4")
    twice = long.unionByName(long.selectExpr("40L as doc_id", *long.columns[1:]))
    ids = {v for r in op(twice).collect() for v in (r[0], r[3])}
    assert ids == {4, 40}


def _table(spark, docs):
    return spark.createDataFrame([(k, " ".join(w)) for k, w in docs.items()], "doc_id long, text string")


def test_decoys_hide_no_passage(spark):
    """Other documents with one seed each, before and between two documents with an exact passage."""
    rng = random.Random(3)
    text = lambda n: [f"u{rng.getrandbits(50)}" for _ in range(n)]
    shared = text(60)
    docs = {100: text(20) + shared + text(20), 300: text(30) + shared + text(10)}
    for i in range(57):
        for base in (0, 200):
            docs[base + i] = text(40) + shared[i:i + 4] + text(40)
    got = {(r.doc_id, r.other_id, r.start_word, r.end_word, r.other_start) for r in chaining.op5(_table(spark, docs)).collect()}
    assert got == {(300, 100, 30, 90, 20)}


def test_shared_seeds_are_those_of_several_documents(spark, monkeypatch):
    rng = random.Random(5)
    docs = corpus(5)
    docs.update({100 + i: [rng.choice("abc") for _ in range(60)] for i in range(40)})
    docs.update({k: [f"{k}-{i}" for i in range(60)] + ["one", "phrase", "of", "five", "words"] for k in (200, 201)})
    held = {}
    for k, w in docs.items():
        for i in range(len(w) - 3 if len(w) >= 50 else 0):
            held.setdefault(tuple(w[i:i + 4]), set()).add((k, i))
    known = {o for at in held.values() if len({k for k, _ in at}) > 1 for o in at}
    want = sorted((k, i) for k, i in known if sum((k, j) in known for j in range(i - 46, i + 47)) >= 7)
    assert 7 == chaining.MIN_SEEDS and len(want) < len(known)
    monkeypatch.setattr(chaining, "BUCKET_BYTES", 256)
    for parts in (1, 7):
        slices = chaining._written(chaining.sliced(_table(spark, docs).repartition(parts)), "slices")
        assert sorted((r.doc_id, r.pos) for r in chaining.shared_seeds(slices).collect()) == want


def test_links_join_all_documents(spark, monkeypatch):
    """Rows of a key join all others whose document and label differ, in blocks as well."""
    rng = random.Random(6)
    rows = sorted({(rng.randrange(60), rng.randrange(chaining.RARE), rng.randrange(30)) for _ in range(1500)})
    rows += [(99, d, 0) for d in range(40)] + [(98, d, p) for d in range(50) for p in range(d % 3)]
    label = lambda k, d: d % 7 if k == 98 else d
    places = {}
    for k, d, p in rows:
        places.setdefault(k, {}).setdefault(d, []).append(p)
    want = {(a, b, x[min(i, len(x) - 1)], y[min(i, len(y) - 1)])
            for k, docs in places.items() for a, x in docs.items() for b, y in docs.items()
            if a < b and label(k, a) != label(k, b) for i in range(max(len(x), len(y)))}
    table = chaining._written(spark.createDataFrame([(*r, 0, label(*r[:2])) for r in rows],
                                                    "key long, doc_id long, pos long, hot int, label long"), "seeds")
    for size in (7, 4096):
        monkeypatch.setattr(chaining, "BLOCK", size)
        got = [tuple(r)[:4] for r in chaining.anchors(table).collect()]
        assert set(got) == want


def test_frequent_seeds_hide_no_passage(spark, monkeypatch):
    """Every seed of a passage is in more than RARE other documents, before and between the two that have all of it."""
    monkeypatch.setattr(chaining, "RARE", 16)
    rng = random.Random(9)
    text = lambda n: [f"u{rng.getrandbits(50)}" for _ in range(n)]
    shared = text(60)
    edited = [w if i % 7 else "edit" for i, w in enumerate(shared)]
    docs = {1000: text(20) + shared + text(20), 2000: text(30) + shared + text(10), 2500: text(9) + edited}
    n = 0
    for i in range(0, 51, 2):
        for _ in range(chaining.RARE):
            for base in (0, 1001):
                docs[base + n] = text(40) + shared[i:i + 12] + text(40)
            n += 1
    got = {(r.doc_id, r.other_id): r.matched for r in chaining.op5(_table(spark, docs)).collect()}
    assert got == {(2000, 1000): 60, (2500, 1000): 51, (2500, 2000): 51}


def test_passages_of_one_class_are_linked_with_its_first(spark, monkeypatch):
    """An equal passage of many documents joins each with the first; another one in two of them is found as well."""
    monkeypatch.setattr(chaining, "RARE", 16)
    rng = random.Random(10)
    text = lambda n: [f"u{rng.getrandbits(50)}" for _ in range(n)]
    common, line = text(70), text(12)
    docs = {k: text(60) + common + text(5) for k in range(40)}
    for k in range(100, 140):
        docs[k] = text(50) + line + text(50)
    near = text(45)
    docs[117] = text(20) + near[:20] + line + near[20:] + text(20)
    docs[131] = text(50) + near[:20] + line + near[20:30] + ["x"] + near[31:]
    other = text(30) + line + text(30)
    docs[25] += text(60) + other
    docs[31] += text(70) + other
    got = {(r.doc_id, r.other_id, r.start_word, r.end_word) for r in chaining.op5(_table(spark, docs)).collect()}
    assert got == {(k, 0, 60, 130) for k in range(1, 40)} | {(131, 117, 50, 107), (31, 25, 205, 277)}


def test_copies_are_one_document(spark):
    """A copy has one row; the rows of the smallest id hold for it."""
    rng = random.Random(8)
    text = [f"u{rng.getrandbits(50)}" for _ in range(80)]
    docs = {k: text for k in (5, 6, 9)} | {7: text[:70] + ["x"], 8: text[:10]}
    table = _table(spark, docs).unionByName(_table(spark, {9: text, 3: text[:60] + ["y"]}))
    got = sorted((r.doc_id, r.other_id, r.start_word, r.end_word, r.matched) for r in chaining.op5(table).collect())
    assert [g for g in got if g[4] == 80] == [(6, 5, 0, 80, 80), (9, 5, 0, 80, 80)]
    assert {g[:2] for g in got} == {(5, 3), (7, 3), (7, 5), (6, 5), (9, 5)}


def test_words_near_a_seed_are_the_rarest_of_a_window():
    """Words of a frequent line, more frequent than those around it, make no keys though they are next to the seed."""
    rng = np.random.default_rng(7)
    hashes = rng.integers(0, 1 << 63, 60).astype(np.uint64) * np.uint64(2)
    for n in (49, 50, 51, 90, 140):
        h = hashes[rng.integers(0, len(hashes), n)]
        order = rng.permutation(1 << chaining.ORDER_BITS).astype(np.int32)
        rank = order[h >> np.uint64(64 - chaining.ORDER_BITS)]
        pos = np.unique(rng.integers(0, n - 3, 5))
        key = rng.integers(0, 1 << 62, len(pos))
        want, most = set(), set()
        for i, q in enumerate(pos):
            for s in range(max(0, q - 46), min(q, n - 50) + 1):
                others = [p for p in range(s, s + 50) if not q <= p < q + 4]
                for p in others:
                    rarer = sum(rank[x] < rank[p] for x in others)
                    near = int(chaining.mix(key[i:i + 1].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + h[p:p + 1])[0]), i
                    if rarer < 11:
                        want.add(near)
                    if rarer < 15:
                        most.add(near)
        keys, rows = chaining._with_words(h, key, pos, order)
        assert want <= set(zip(keys.tolist(), rows.tolist())) <= most
    # a line of 16 words ranked last, its seed at its sixth word
    h = (np.arange(1, 101, dtype=np.uint64) << np.uint64(48))
    order = np.zeros(1 << chaining.ORDER_BITS, np.int32)
    order[1:101] = np.where((np.arange(100) >= 40) & (np.arange(100) < 56), 1000 + np.arange(100), np.arange(100))
    keys, _ = chaining._with_words(h, np.array([5]), np.array([45]), order)
    line = chaining.mix(np.uint64(5) * np.uint64(0x9E3779B97F4A7C15) + h[40:56])
    assert len(keys) and not set(keys.tolist()) & set(line.tolist())


def test_frequent_seeds_with_words_hide_no_passage(spark, monkeypatch):
    """The same where every frequent seed is joined with the words near it."""
    monkeypatch.setattr(chaining, "FEW", 0)
    test_frequent_seeds_hide_no_passage(spark, monkeypatch)
