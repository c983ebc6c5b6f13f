"""Collocations against a plain count, and the filter that tells which phrases are active."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from usagelake.llm import collocations as C

ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, min_count, longest=5, top=2000, within=100):
    """``rows``: (text, lang) -> the result's rows, counted phrase by phrase."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(ASCII_LOWER)):
            ws = [w for w in re.split("[ \t]", piece) if w]
            n[lang] += len(ws)
            for k in range(1, longest + 1):
                for i in range(len(ws) - k + 1):
                    f[lang, tuple(ws[i:i + k])] += 1
    cand = {p: a for p, a in f.items() if len(p[1]) >= 2 and a >= min_count}
    bad = set()
    for (lang, ws), m in cand.items():
        for k in range(2, len(ws)):
            for i in range(len(ws) - k + 1):
                sub = (lang, ws[i:i + k])
                if 100 * m >= within * cand[sub]:
                    bad.add(sub)
    by_lang = {}
    for (lang, ws), a in cand.items():
        if (lang, ws) not in bad:
            score, k = min((1000 * a * n[lang] // (f[lang, ws[:k]] * f[lang, ws[k:]]), k) for k in range(1, len(ws)))
            phrase = " ".join(ws)
            by_lang.setdefault(lang, []).append(
                (-score, -a, phrase.encode(), phrase, f[lang, ws[:k]], f[lang, ws[k:]], n[lang]))
    return sorted((lang, i + 1, p, -a, l, r, n, -s) for lang, found in by_lang.items()
                  for i, (s, a, _, p, l, r, n) in enumerate(sorted(found)[:top]))


def texts(seed, docs, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["Ünï", "the", "The", "x\U0001F600y"]
    fixed = ["New York City", "in spite of the", "one two three four five six seven", "aa aa aa aa"]
    out = []
    for _ in range(docs):
        ws = []
        for _ in range(words):
            ws.append(rng.choice(fixed) if rng.random() < 0.15 else vocabulary[min(int(rng.expovariate(0.12)), 43)])
            ws.append(rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", " ; ", "\r\n"]))
        out.append(("".join(ws), rng.choice(["en", "en", "en", "de", None])))
    return out


def found(df, **args):
    return sorted(tuple(r) for r in C.collocations(df, **args).collect())


@pytest.mark.parametrize("shards,min_count,within", [(3, 8, 100), (4, 15, 70)])
def test_equals_a_plain_count(spark, shards, min_count, within):
    rows = texts(shards, 120)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string").repartition(5)
    want = plain(rows, min_count, within=within)
    assert found(df, shards=shards, min_count=min_count, within=within) == want
    assert len(want) >= 30 and {len(r[2].split()) for r in want} == {2, 3, 4, 5}


def test_top_with_ties(spark):
    rows = [("a b. c d. e f. g h", "en")] * 10 + [("a b c", "fr")] * 4
    df = spark.createDataFrame([(1, *r) for r in rows], "doc_id long, text string, lang string")
    want = plain(rows, 4, top=2)
    assert found(df, min_count=4, top=2) == want and [r[2] for r in want] == ["a b", "c d", "a b c"]


def test_a_full_filter_changes_no_count(spark, monkeypatch):
    """With nearly every bit set, phrases are counted that need not be; the result is the same."""
    monkeypatch.setattr(C, "LEAST_BITS", 64)
    monkeypatch.setattr(C, "MOST_BITS", 64)
    rows = texts(9, 80)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string")
    assert found(df, min_count=8) == plain(rows, 8)


def test_odd_and_empty_tables(spark, odd, empty):
    rows = [(r["text"], r["lang"]) for r in odd.collect()]
    assert found(odd, min_count=2) == plain(rows, 2)
    clash = odd.withColumns({c: F.lit(1) for c in ("h", "n", "words", "shard", "k", "a", "since")})
    assert found(clash, min_count=2) == plain(rows, 2)
    assert C.op12(empty).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, " .. ", "en")], "doc_id long, text string, lang string")
    assert C.op12(blank).count() == 0


def test_bits_of_spark_and_numpy_agree(spark):
    h = np.random.default_rng(1).integers(-2**63, 2**63, 500)
    df = spark.createDataFrame([(int(x),) for x in h], "h long")
    bits = C._bits(df, 1 << 14)
    assert C._has(bits, h.view(np.uint64)).all()
    other = np.random.default_rng(2).integers(-2**63, 2**63, 5000).view(np.uint64)
    assert C._has(bits, other).mean() < 0.05


def test_large_numbers_are_exact(spark):
    """The products of a score pass 64 bits."""
    kept = spark.createDataFrame([(1, "en", 10**12, 10**14, [2], [3])], "h long, lang string, a long, n long, pre array<long>, post array<long>")
    freq = spark.createDataFrame([(2, 10**12 + 7), (3, 3 * 10**12 + 1)], "h long, n long")
    r = C._scored(kept, freq).first()
    assert r["score"] == 1000 * 10**12 * 10**14 // ((10**12 + 7) * (3 * 10**12 + 1))
