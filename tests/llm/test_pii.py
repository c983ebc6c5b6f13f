import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from usagelake.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for n, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
                if not 12 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), n, m.end()))
    return sorted(out)


@given(st.lists(st.sampled_from(list("ab.@+-() 0159%") + ["a@b.c", "1.2.3.4", "+1 (23) 456-7890", "4111 1111 1111 1111",
                                                          "é", "\n", "..", "256"]), max_size=30).map("".join))
@settings(max_examples=400, deadline=None)
def test_base_spans_equal_the_plain_patterns(text):
    assert pii.base_spans(text) == plain(text)


@pytest.fixture(scope="module")
def weights(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return pii.train(pii.training_regions(docs))


def spans(text, w):
    return pii.span_text(pii.all_spans(text, pii.base_spans(text), w))


@pytest.mark.parametrize("text, want", [
    ("mail joe [at] example.com now", "email:5:25"),
    ("mail john(at)x1.org now", "email:5:19"),
    ("call (017) 555-7713 now", "phone:5:19"),
    ("host 10.2[.]3[.]4 up", "ip:5:17"),
    ("number 9807915762804491 stays", ""),
    ('token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', ""),
    ("version 3.2.1 of 2024-01-05, licence 4.0.", ""),
    ("plain words only", ""),
    ("a.34@mail7.example.com", "email:0:22"),
])
def test_the_field_adds_written_out_forms(weights, text, want):
    assert spans(text, weights) == want


def test_dynamic_programming_finds_the_best_segmentation(weights):
    r = pii.Region("und.3@m1.de +1 (017) 555-7713", 0, 29)
    scores = pii._scores(r, weights)

    def best(i):
        if i == len(r.units):
            return 0.0
        return max([best(i + 1)] + [max(s) + best(j) for j, _, s in scores[i]])

    def value(found):
        total = 0.0
        for s, k, e in found:
            i = [u[0] for u in r.units].index(s)
            total += next(x[k] for j, _, x in scores[i] if r.units[j - 1][1] == e)
        return total

    assert value(pii.decode(r, weights)) == pytest.approx(best(0))


def test_gradient_equals_finite_differences(weights):
    r = pii.Region("4111 1111 1.2.3.4", 0, 17)
    gold = {(0, 3): 2}

    def loglik(w):
        seg = pii._scores(r, w)
        alpha = np.full(len(r.units) + 1, -np.inf)
        alpha[0] = 0
        for i in range(len(r.units)):
            alpha[i + 1] = np.logaddexp(alpha[i + 1], alpha[i])
            for j, _, s in seg[i]:
                alpha[j] = np.logaddexp(alpha[j], alpha[i] + np.logaddexp.reduce(s))
        return sum(s[gold[i, j]] for i in range(len(r.units)) for j, _, s in seg[i] if (i, j) in gold) - alpha[-1]

    w = weights * 0.1
    g = pii._gradient(r, gold, w)
    for k, f in ((2, 0), (1, 9), (2, 11), (3, 17)):
        d = np.zeros_like(w)
        d[k, f] = 1e-5
        assert (loglik(w + d) - loglik(w - d)) / 2e-5 == pytest.approx(g[k, f], abs=1e-4)


def test_query_equals_plain_digest(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    text = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    kinds = list(PATTERNS)
    for r in pii.op2(docs).collect():
        want = plain(text[r.doc_id])
        marks = ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in want)
        assert r.base_sha256 == hashlib.sha256(marks.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for _, k, _ in want) for n in range(4)]
        assert set(marks.split(",")) - {""} <= set(r.spans.split(","))


def test_odd_rows(odd, empty, weights):
    got = {r.doc_id: r for r in pii.op2(odd).collect()}
    assert got[1].spans == got[2].spans == got[3].spans == ""
    assert pii.op2(empty).collect() == []
    out = pii.redacted(odd, weights)
    assert out.columns == odd.columns and out.exceptAll(odd).count() == 0


def test_redaction(spark, weights):
    docs = spark.createDataFrame([(1, "Ä mail a.b@c.de or +1 (017) 555-7713."), (2, None)], "doc_id long, text string")
    assert [r.text for r in pii.redacted(docs, weights).orderBy("doc_id").collect()] == ["Ä mail <EMAIL> or <PHONE>.", None]
