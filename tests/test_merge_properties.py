"""Merge laws against a plain-Python fold on random delta sets (hypothesis)."""

from hypothesis import HealthCheck, given, settings, strategies as st

from usagelake.streaming import cells
from usagelake.streaming.cells import as_deltas

ROWS = st.sampled_from(["r1", "r2"])
QUALS = st.sampled_from(["q1", "q2", "q3"])
# (row, qualifier, op, num, text, epoch, seq)
DELTA = st.tuples(ROWS, QUALS, st.sampled_from(["add", "add", "add", "set", "delete"]),
                  st.integers(-5, 50), st.sampled_from(["a", "b", "c"]),
                  st.integers(0, 6), st.integers(0, 3))


def _df(spark, rows, law):
    data = []
    for i, (r, q, op, n, t, e, s) in enumerate(rows):
        fam = None if op == "delete" else "f"
        qual = None if op == "delete" else q
        num = n if law == cells.SUM and op != "delete" else None
        text = None if (law == cells.SUM or op == "delete") else t
        # unique order per row so LAST has one winner
        data.append(("T", r, fam, qual, op, num, text, e, s * 1000 + i))
    df = spark.createDataFrame(data, "tbl string, row_key string, family string, qualifier string, "
                                     "op string, num long, text string, epoch long, seq long")
    return as_deltas(df), data


def _fold(data, law):
    """Reference semantics: latest tombstone / set hides older rows."""
    order = lambda d: (d[7], d[8])
    tomb = {}
    for d in data:
        if d[4] == "delete":
            tomb[d[1]] = max(tomb.get(d[1], (-1, -1)), order(d))
    live = [d for d in data if d[4] != "delete" and order(d) > tomb.get(d[1], (-1, -1))]
    last_set = {}
    for d in live:
        if d[4] == "set":
            k = (d[1], d[3])
            last_set[k] = max(last_set.get(k, (-1, -1)), order(d))
    live = [d for d in live if (d[1], d[3]) not in last_set or order(d) > last_set[(d[1], d[3])]
            or (d[4] == "set" and order(d) == last_set[(d[1], d[3])])]
    out = {}
    if law == cells.SUM:
        for d in live:
            out[(d[1], d[3])] = out.get((d[1], d[3]), 0) + d[5]
        return sorted(out.items())
    if law == cells.UNION:
        return sorted({(d[1], d[3], m) for d in live for m in d[6].split(",") if m})
    best = {}
    for d in live:
        k = (d[1], d[3])
        if k not in best or order(d) > order(best[k]):
            best[k] = d
    return sorted((k, v[6]) for k, v in best.items())


SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(DELTA, min_size=1, max_size=14), st.randoms(use_true_random=False))
def test_sum_law(spark, rows, rnd):
    rnd.shuffle(rows)
    df, data = _df(spark, rows, cells.SUM)
    got = sorted(((r["row_key"], r["qualifier"]), r["value"]) for r in cells.merge_sum(df).collect())
    assert got == _fold(data, cells.SUM)


@SETTINGS
@given(st.lists(DELTA, min_size=1, max_size=14))
def test_union_law(spark, rows):
    df, data = _df(spark, rows, cells.UNION)
    got = sorted((r["row_key"], r["qualifier"], r["member"]) for r in cells.merge_union(df).collect())
    assert got == _fold(data, cells.UNION)


@SETTINGS
@given(st.lists(DELTA, min_size=1, max_size=14))
def test_last_law(spark, rows):
    df, data = _df(spark, rows, cells.LAST)
    got = sorted(((r["row_key"], r["qualifier"]), r["value"]) for r in cells.merge_last(df).collect())
    assert got == _fold(data, cells.LAST)
