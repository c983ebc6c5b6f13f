"""Cell store: admin writes, tombstones, merge laws, replay safety."""

import os

import pytest
from pyspark.sql import functions as F

from usagelake.operators.model import Usage
from usagelake.sources.fixture import usage_sessions
from usagelake.streaming import cells
from usagelake.streaming.cells import CellStore, as_deltas
from usagelake.streaming.pipeline import metric_deltas

from conftest import SF_SMALL


def _d(spark, rows):
    # (tbl, row, family, qualifier, num, text, epoch, seq)
    df = spark.createDataFrame(rows, "tbl string, row_key string, family string, qualifier string, "
                                     "num long, text string, epoch long, seq long")
    return as_deltas(df)


def test_sum_union_last_laws(spark):
    d = _d(spark, [
        ("T", "r", "f", "q", 2, None, 0, 0), ("T", "r", "f", "q", 3, None, 2, 0),
        ("T", "r", "f", "q2", 1, None, 2, 0),
    ])
    assert sorted((r["qualifier"], r["value"]) for r in cells.merge_sum(d).collect()) == [("q", 5), ("q2", 1)]
    u = _d(spark, [("T", "r", "user", "d", None, "a", 0, 0), ("T", "r", "user", "d", None, "b", 2, 0),
                   ("T", "r", "user", "d", None, "a", 2, 0)])
    assert sorted(r["member"] for r in cells.merge_union(u).collect()) == ["a", "b"]
    last = _d(spark, [("T", "r", "v", "d", None, "old", 0, 9), ("T", "r", "v", "d", None, "new", 2, 0),
                      ("T", "r", "v", "d", None, "mid", 0, 10)])
    assert cells.merge_last(last).first()["value"] == "new"


def test_sum_and_union_are_order_and_split_invariant(spark):
    u = Usage.from_sessions(usage_sessions(spark, SF_SMALL))
    whole = metric_deltas(u, laws=(cells.SUM, cells.UNION))
    s = usage_sessions(spark, SF_SMALL)
    parts = None
    # split reports by a hash of report_id into 3 batches, written in reverse order
    for i, b in enumerate((2, 1, 0)):
        part = Usage.from_sessions(s.filter(F.pmod(F.xxhash64("report_id"), F.lit(3)) == b))
        d = metric_deltas(part, laws=(cells.SUM, cells.UNION)).withColumn("epoch", F.lit(2 * i).cast("bigint"))
        parts = d if parts is None else parts.unionByName(d)
    a = cells.merge_sum(cells.deltas_of_law(whole, cells.SUM), admin=False)
    b = cells.merge_sum(cells.deltas_of_law(parts, cells.SUM), admin=False)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    a = cells.merge_union(cells.deltas_of_law(whole, cells.UNION), admin=False)
    b = cells.merge_union(cells.deltas_of_law(parts, cells.UNION), admin=False)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_store_admin_ops(spark, scratch):
    st = CellStore(spark, os.path.join(scratch, "store"))
    assert st.create_table("AIV", cells.TABLE_FAMILIES["AIV"]) is True
    assert st.create_table("AIV", cells.TABLE_FAMILIES["AIV"]) is False
    st.create_default_tables()
    d = _d(spark, [("AIV", "2018-03-10", "brand", "B1", 4, None, 0, 0),
                   ("AIV", "2018-03-10", "brand", "B2", 1, None, 0, 0),
                   ("AIV", "2018-03-11", "brand", "B1", 7, None, 0, 0)])
    st.write_batch(d, 0)
    g = {r["qualifier"]: r["value"] for r in st.get("AIV", "2018-03-10", "brand").collect()}
    assert g == {"B1": "4", "B2": "1"}
    # put overwrites a SUM cell; later stream deltas add on top
    st.put("AIV", "2018-03-10", "brand", "B1", 100)
    st.write_batch(_d(spark, [("AIV", "2018-03-10", "brand", "B1", 5, None, 0, 0)]), 1)
    g = {r["qualifier"]: r["value"] for r in st.get("AIV", "2018-03-10", "brand").collect()}
    assert g == {"B1": "105", "B2": "1"}
    fm = st.get_family_map("AIV", "2018-03-10", "brand").first()["brand"]
    assert fm == {"B1": "105", "B2": "1"}
    # delete a row: everything before is hidden, later writes show again
    st.delete_row("AIV", "2018-03-10")
    assert st.get("AIV", "2018-03-10").count() == 0
    assert st.get("AIV", "missing").count() == 0
    st.write_batch(_d(spark, [("AIV", "2018-03-10", "model", "M", 2, None, 0, 0)]), 2)
    assert [(r["family"], r["value"]) for r in st.get("AIV", "2018-03-10").collect()] == [("model", "2")]
    scan = st.scan("AIV").collect()
    assert {(r["row_key"], r["family"], r["qualifier"], r["value"]) for r in scan} == \
        {("2018-03-11", "brand", "B1", "7"), ("2018-03-10", "model", "M", "2")}
    # put_row on a LAST family and a UNION put
    st.put_row("USER", "u1", "usage_times", {"2018-03-10": 3, "2018-03-11": 4})
    st.put("SINGLE_APP", "com.a", "user", "2018-03-10", "u1,u2")
    assert {r["qualifier"]: r["value"] for r in st.get("USER", "u1").collect()} == \
        {"2018-03-10": "3", "2018-03-11": "4"}
    assert sorted(r["value"] for r in st.get("SINGLE_APP", "com.a", "user").collect()) == ["u1", "u2"]
    assert st.drop_table("AIV") is True and st.drop_table("AIV") is False
    assert st.scan("AIV").count() == 0


def test_replayed_batch_is_idempotent(spark, scratch):
    st = CellStore(spark, os.path.join(scratch, "store"))
    st.create_default_tables()
    u = Usage.from_sessions(usage_sessions(spark, SF_SMALL))
    d = metric_deltas(u)
    st.write_batch(d, 0)
    first = st.scan("SINGLE_APP").collect()
    st.write_batch(d, 0)  # a retried batch
    again = st.scan("SINGLE_APP").collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))


def test_fused_report_path_equals_long_path(spark):
    from usagelake.operators.model import nest_reports
    from usagelake.streaming.pipeline import report_deltas
    s = usage_sessions(spark, SF_SMALL)
    reports = nest_reports(s)
    for law, fn in ((cells.SUM, cells.merge_sum), (cells.UNION, cells.merge_union),
                    (cells.LAST, cells.merge_last)):
        a = fn(report_deltas(reports, laws=(law,)), admin=False)
        b = fn(metric_deltas(Usage.from_sessions(s), laws=(law,)), admin=False)
        assert a.count() > 0
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, law


def _state(st):
    out = set()
    for t in ("AIV", "SINGLE_APP", "USER"):
        out |= {(t, r["row_key"], r["family"], r["qualifier"], r["value"]) for r in st.scan(t).collect()}
    return out


def test_compaction_preserves_reads(spark, scratch):
    st = CellStore(spark, os.path.join(scratch, "store"))
    st.create_default_tables()
    st.write_batch(_d(spark, [("AIV", "d1", "brand", "B1", 4, None, 0, 0),
                              ("AIV", "d2", "brand", "B1", 1, None, 0, 0)]), 0)
    st.write_batch(_d(spark, [("SINGLE_APP", "com.a", "user", "d1", None, "u1", 0, 0),
                              ("USER", "u1", "usage_times", "d1", None, "3", 0, 5),
                              ("AIV", "d1", "brand", "B1", 2, None, 0, 0)]), 1)
    st.put("AIV", "d2", "brand", "B1", 10)
    st.delete_row("USER", "u9")
    st.write_batch(_d(spark, [("USER", "u1", "usage_times", "d1", None, "7", 0, 1),
                              ("SINGLE_APP", "com.a", "user", "d1", None, "u2", 0, 0)]), 2)
    before = _state(st)
    assert ("AIV", "d1", "brand", "B1", "6") in before and ("AIV", "d2", "brand", "B1", "10") in before
    assert ("USER", "u1", "usage_times", "d1", "7") in before
    assert st.compact(upto=1) == 1
    assert _state(st) == before
    # later writes land on top of the snapshot
    st.write_batch(_d(spark, [("AIV", "d1", "brand", "B1", 1, None, 0, 0)]), 3)
    st.delete_row("AIV", "d2")
    after = _state(st)
    assert ("AIV", "d1", "brand", "B1", "7") in after
    assert not any(r[1] == "d2" for r in after)
    assert st.compact() == 3
    st.purge(3)
    assert _state(st) == after
    assert st.last_batch() == 3


def _aiv(st, key="d1"):
    return {r["qualifier"]: r["value"] for r in st.get("AIV", key).collect()}


def test_admin_writes_after_a_compaction(spark, scratch):
    """Puts and deletes give the same reads before and after compactions and purges."""
    st = CellStore(spark, os.path.join(scratch, "store"))
    st.create_default_tables()
    st.write_batch(_d(spark, [("AIV", "d1", "brand", "B1", 5, None, 0, 0), ("AIV", "d2", "brand", "B1", 1, None, 0, 0)]), 0)
    st.compact()
    st.put("AIV", "d1", "brand", "B1", 99)
    assert _aiv(st) == {"B1": "99"}
    assert st.compact() == 0 and _aiv(st) == {"B1": "99"}
    st.delete_row("AIV", "d2")
    assert _aiv(st, "d2") == {}
    st.write_batch(_d(spark, [("AIV", "d1", "brand", "B1", 1, None, 0, 0)]), 1)
    assert _aiv(st) == {"B1": "100"}
    st.compact()
    st.purge(1)
    assert _aiv(st) == {"B1": "100"} and _aiv(st, "d2") == {}
    st.delete_row("AIV", "d1")
    assert _aiv(st) == {}
    st.put("AIV", "d1", "brand", "B2", 3)
    st.put("AIV", "d1", "brand", "B2", 4)
    st.write_batch(_d(spark, [("AIV", "d2", "brand", "B9", 1, None, 0, 0)]), 2)
    st.compact()
    st.purge(2)
    assert _aiv(st) == {"B2": "4"} and _aiv(st, "d2") == {"B9": "1"}
    assert st.last_batch() == 2


def test_dropped_table_stays_empty(spark, scratch):
    st = CellStore(spark, os.path.join(scratch, "store"))
    st.create_default_tables()
    st.write_batch(_d(spark, [("AIV", "d1", "brand", "B1", 5, None, 0, 0), ("USER", "u", "hobby", "k", 1, None, 0, 0)]), 0)
    st.compact()
    assert st.drop_table("AIV") and st.scan("AIV").count() == 0 and st.get("AIV", "d1").count() == 0
    st.compact()
    assert st.create_table("AIV", cells.TABLE_FAMILIES["AIV"]) and st.scan("AIV").count() == 0
    st.write_batch(_d(spark, [("AIV", "d1", "brand", "B1", 2, None, 0, 0)]), 1)
    assert _aiv(st) == {"B1": "2"}
    st.compact()
    assert _aiv(st) == {"B1": "2"} and st.scan("USER").count() == 1


def test_put_frame(spark, scratch):
    st = CellStore(spark, os.path.join(scratch, "store"))
    st.create_default_tables()
    st.write_batch(_d(spark, [("AIV", "d1", "brand", "B1", 5, None, 0, 0)]), 0)
    rows = [("d1", "brand", "B1", "7"), ("d3", "brand", "B1", "8")]
    st.put_frame("AIV", spark.createDataFrame(rows, "row_key string, family string, qualifier string, value string"))
    assert _aiv(st) == {"B1": "7"} and _aiv(st, "d3") == {"B1": "8"}
    with pytest.raises(KeyError):
        st.put_frame("AIV", spark.createDataFrame([("d", "none", "q", "1")],
                                                  "row_key string, family string, qualifier string, value string"))


def test_empty_members_are_kept(spark):
    u = _d(spark, [("SINGLE_APP", "r", "user", "d", None, "", 0, 0), ("SINGLE_APP", "r", "user", "d", None, "a", 0, 0)])
    assert sorted(r["member"] for r in cells.merge_union(u).collect()) == ["", "a"]
    s = u.unionByName(_d(spark, [("SINGLE_APP", "r", "user", "d", None, "", 5, 0)]).withColumn("op", F.lit("set")))
    assert cells.merge_union(s).count() == 0  # a set to the empty list


def test_merge_maps(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, n long")
    b = spark.createDataFrame([("y", 3), ("z", 4)], "k string, n long")
    assert sorted(map(tuple, cells.merge_maps(a, b, "k").collect())) == [("x", 1), ("y", 5), ("z", 4)]
