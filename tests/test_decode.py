import json

from usagelake.operators.model import Usage, nest_reports
from usagelake.sources.fixture import usage_sessions
from usagelake.sources.reports import decode_lines, decode_status_counts, reports_decode, reports_encode

from conftest import SF_SMALL

GOOD = {"user_id": "u1", "province": "P", "city": "C", "date": "2018-03-10", "brand": "B",
        "model": "M", "language": "zh", "system_version": "7.0", "resolution": "1080x1920",
        "net_status": "wifi", "ISP": "X",
        "apps": [{"package_name": "com.a", "beginTime": 1520640000000, "endTime": 1520640301000,
                  "version": "2.0", "kind": "news"}]}


def _variant(**change):
    d = json.loads(json.dumps(GOOD))
    for k, v in change.items():
        if v is KeyError:
            d.pop(k)
        else:
            d[k] = v
    return json.dumps(d)


def test_status_cases(spark):
    frac = json.dumps(GOOD).replace("1520640000000", "1520640000000.0")
    cases = [
        (_variant(extra=1), 1),
        (_variant(user_id=5), 0),
        (_variant(user_id=None), 0),
        (_variant(user_id=KeyError), 0),
        (frac, 1),
        ("[" + json.dumps(GOOD) + "]", 0),
        ('{"a":', -1),
        ("", -1),
        (_variant(apps=[]), 1),
        (_variant(apps=[{"package_name": "x"}]), 0),
        (_variant(apps="no"), 0),
    ]
    df = spark.createDataFrame([(c,) for c, _ in cases], "value string")
    got = [r["status"] for r in decode_lines(df).collect()]
    assert got == [s for _, s in cases]
    counts = {r["status"]: r["lines"] for r in decode_status_counts(df).collect()}
    assert counts == {1: 3, 0: 6, -1: 2}


def test_decode_fields(spark):
    df = spark.createDataFrame([(json.dumps(GOOD),)], "value string")
    r = reports_decode(df).first()
    assert r["isp"] == "X" and r["user_id"] == "u1"
    a = r["apps"][0]
    assert (a["package_name"], a["begin_time"], a["end_time"]) == ("com.a", 1520640000000, 1520640301000)


def test_encode_decode_roundtrip(spark):
    reports = nest_reports(usage_sessions(spark, SF_SMALL))
    lines = reports_encode(reports)
    back = reports_decode(lines, report_id=lines["report_id"])
    a = Usage.from_reports(back).facts.select("report_id", "user_id", "sessions", "duration_ms")
    b = Usage.from_reports(reports).facts.select("report_id", "user_id", "sessions", "duration_ms")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    first = json.loads(lines.first()["value"])
    assert list(first)[:5] == ["user_id", "province", "city", "date", "apps"]
    assert set(first["apps"][0]) == {"package_name", "beginTime", "endTime", "version", "kind"}


def test_one_parse_per_line(spark):
    lines = spark.createDataFrame([(json.dumps(GOOD),)], "value string")
    plan = reports_decode(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson(") == 1


def test_whole_decimals_are_longs(spark):
    def status(value):
        app = json.dumps(dict(GOOD["apps"][0], beginTime=None)).replace("null", value)
        line = json.dumps(dict(GOOD, apps=[])).replace("[]", f"[{app}]")
        df = spark.createDataFrame([(line,)], "value string")
        rows = reports_decode(df).collect()
        return decode_lines(df).first()["status"], rows[0]["apps"][0]["begin_time"] if rows else None

    assert status("1520640000000.0") == (1, 1520640000000)
    assert status("1.5")[0] == 0 and status("1e400")[0] in (0, -1) and status("1e30")[0] == 0
    assert status("2e3") == (1, 2000)
