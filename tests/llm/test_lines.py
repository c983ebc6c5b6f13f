"""Line dedup against a plain version, and the levels of its runs."""

import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from usagelake.llm import lines

WHITE = " \t\n\x0b\x0c\r"
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, min_length=40, min_docs=5):
    """``rows``: (doc_id, text) -> sorted (doc_id, n_lines, n_dropped, sha256)."""
    holders = defaultdict(set)
    cut = [(d, (t or "").split("\n")) for d, t in rows]
    key = lambda line: line.strip(WHITE).translate(ASCII_LOWER)
    for d, ls in cut:
        for line in ls:
            if len(key(line)) >= min_length:
                holders[key(line)].add(d)
    out = []
    for d, ls in cut:
        kept = []
        for line in ls:
            own = holders.get(key(line), ())
            keeper = max((x for x in own if x is not None), default=None)
            if len(own) < min_docs or d == keeper:
                kept.append(line)
        out.append((d, len(ls), len(ls) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in lines.op11(df).collect()), key=repr)


def test_equals_a_plain_version(spark):
    rng = random.Random(5)
    common = [f"Shared LINE number {i} " + "äb\U0001F600c " * 6 for i in range(12)] + ["short shared line"]
    rows = []
    for d in range(300):
        ls = [f"own line {rng.random()} of document {d} and some more words"] * rng.randint(0, 2)
        for c in rng.sample(common, rng.randint(0, 6)):
            ls.append(rng.choice(["", " \t", "\x0b"]) + rng.choice([c, c.upper().replace("Ä", "ä"), c]) + rng.choice(["", "\r", "  "]))
        rng.shuffle(ls)
        rows.append((d * 7, "\n".join(ls + ls[:1])))
    four = "a line that four documents have, which is one too few for it"
    rows += [(5000 + i, four) for i in range(4)] + [(6000, None), (6001, ""), (6002, "\n\n"), (6003, " \t ")]
    hot = "a line that a third of all documents hold, more than one time each"
    rows += [(7000 + i, f"{hot}\n{i}\n{hot}") for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = found(df)
    assert got == plain(rows)
    assert sum(r[2] for r in got) > 300


def test_repeated_rows_and_missing_ids(spark):
    line = "one line of more than forty code points, found in many documents"
    rows = [(9, line), (9, line), (None, f"{line}\nx"), (None, line), (1, line), (2, f"{line}\n{line}"), (3, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == plain(rows)  # 9, none, 1 and 2 are four documents
    rows.append((4, line.upper()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = found(df)
    assert got == plain(rows) and sum(r[2] for r in got) == 6


def test_odd_and_empty_tables(spark, odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert found(odd) == plain(rows)
    assert lines.op11(empty).count() == 0
    clash = odd.withColumns({c: F.lit(1) for c in ("d", "t", "drop", "pos", "h1", "lines", "keeper")})
    assert found(clash) == plain(rows)
    assert lines.cleaned(clash).select("doc.*").columns == clash.columns


def test_result_does_not_depend_on_batches(spark, documents):
    want = sorted(tuple(r) for r in lines.cleaned(documents, batches=1).select("doc.doc_id", "text").collect())
    got = sorted(tuple(r) for r in lines.cleaned(documents, batches=7).select("doc.doc_id", "text").collect())
    assert got == want


def _run(spark, rows):
    return spark.createDataFrame(rows, "h1 long, h2 long, n_docs long, n_lines long, last long")


def test_levels_of_runs(spark):
    """Two runs of a level become one of the next; the first batch with a key names its keeper."""
    runs = lines.LineRuns(spark, 3)
    shape = []
    for b in range(5):
        runs.add(_run(spark, [(k, -k, 1, 2, 100 - b) for k in range(b, b + 4)]))
        shape.append([len(level) for level in runs.levels])
    assert shape == [[1], [0, 1], [1, 1], [0, 0, 1], [1, 0, 1]]
    got = sorted(tuple(r) for r in runs.folded().collect())
    docs = [sum(k in range(b, b + 4) for b in range(5)) for k in range(8)]
    assert got == [(k, -k, docs[k], 2 * docs[k], 100 - max(0, k - 3)) for k in range(8)]
    assert [len(level) for level in runs.levels][-1] == 1
    runs.drop()


def test_runs_are_not_shuffled(spark):
    """A batch that meets a run moves itself alone; two runs are merged where they lie."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        runs = lines.LineRuns(spark, 4)
        a = runs._write(_run(spark, [(1, 1, 1, 1, 1)]).withColumnRenamed("last", "keeper"))
        b = runs._write(_run(spark, [(2, 2, 1, 1, 1)]).withColumnRenamed("last", "keeper"))
        x, y = spark.table(a[0]), spark.table(b[0])
        plan = x.join(y, lines.KEY, "full")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        fresh = _run(spark, [(1, 1, 1, 1, 1)]).repartition(4, *lines.KEY)
        plan = fresh.join(x, lines.KEY, "left")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("Exchange") == 1
        runs._drop(a)
        runs._drop(b)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
