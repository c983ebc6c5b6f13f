"""A hot report holding half of all sessions: results do not depend on skew handling."""

import time

from usagelake.operators import app, user
from usagelake.operators.model import Usage
from usagelake.streaming.pipeline import with_report_texts

from helpers import BASE_MS, report, reports_df

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",       # force shuffled joins
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
}
PLAIN_CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}


def _reports(spark):
    hot = [(f"com.p{i % 7}", BASE_MS + i * 1000, BASE_MS + i * 1000 + 500 + i, "1.0", "k")
           for i in range(3000)]
    rows = [report("hot", 1, "u0", "d1", hot), report("cold", 0, "u0", "d1", hot[:5])]
    for r in range(300):
        apps = [(f"com.p{(r + j) % 7}", BASE_MS + j, BASE_MS + j + 100, "2.0", "k") for j in range(10)]
        rows.append(report(f"r{r}", 0, f"u{r % 40 + 1}", f"d{r % 3}", apps))
    return reports_df(spark, rows)


def _run(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return sorted(tuple(r) for r in fn().collect())
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_skewed_report_same_results(spark):
    u = Usage.from_reports(_reports(spark))
    cases = {
        "history": lambda: user.user_day_history(u.sessions, u.facts),
        "app_duration": lambda: user.user_day_app_duration(u.sessions, u.facts),
        "history_text": lambda: user.user_day_history_text(u.sessions, u.facts),
        "users_text": lambda: app.app_daily_users_text(u.sessions, pages=5),
        "buckets": lambda: app.app_usage_buckets(u.sessions),
    }
    for name, fn in cases.items():
        a = _run(spark, SKEW_CONF, fn)
        b = _run(spark, PLAIN_CONF, fn)
        assert a == b, name
    hist = _run(spark, PLAIN_CONF, cases["history"])
    assert sum(1 for r in hist if r[0] == "u0") == 3000  # the hot report won and is whole
    texts = [r for r in _run(spark, PLAIN_CONF, cases["history_text"]) if r[0] == "u0"]
    assert len(texts) == 1 and len(texts[0][2].split(",")) == 3000


def test_totals_of_a_report_with_many_packages(spark):
    """The fused path's package totals equal a plain sum, in time linear in the sessions."""
    def seconds(n):
        apps = [(f"com.p{i * 7919 % n:06d}", BASE_MS + i, BASE_MS + i + 1500 + i % 900, "1.0", "k") for i in range(2 * n)]
        df = with_report_texts(reports_df(spark, [report("r", 0, "u", "d", apps)])).select("pkg_totals")
        start = time.time()
        got = df.first()["pkg_totals"]
        spent = time.time() - start
        want = {}
        for p, b, e, _, _ in apps:
            s, m = want.get(p, (0, 0))
            want[p] = (s + (e - b) // 1000, m + e - b)
        assert [(r["package_name"], (r["secs"], r["ms"])) for r in got] == sorted(want.items())
        return spent

    seconds(100)
    small, large = seconds(2_000), seconds(40_000)
    assert large < 20 * max(small, 0.5)


def test_reports_without_sessions_keep_their_user_days(spark):
    u = Usage.from_reports(reports_df(spark, [
        report("a", 0, "u1", "d1", [("com.a", BASE_MS, BASE_MS + 5, "1.0", "k")]), report("b", 1, "u1", "d1", [])]))
    assert [r["history_text"] for r in user.user_day_history_text(u.sessions, u.facts).collect()] == [""]
    assert [r["usage_text"] for r in user.user_day_app_duration_text(u.sessions, u.facts).collect()] == [""]
    assert user.user_day_app_duration(u.sessions, u.facts).count() == 0
