"""Hand-made reports: empty apps, negative spans, repeated user-days."""

from pyspark.sql import functions as F

from usagelake.operators import app, device, population, user
from usagelake.operators.model import Usage

from helpers import BASE_MS, report, reports_df, rows


def _usage(spark):
    h = 3600_000
    data = [
        # empty apps: counts in device/province, 0 ms -> bucket 1, empty texts
        report("r1", 0, "u1", "d1", [], province="P1"),
        # negative span: truncates toward zero, negative total -> bucket 6
        report("r2", 0, "u2", "d1", [("com.a", BASE_MS, BASE_MS - 1500, "1.0", "game")]),
        # two sessions of 1,999 ms -> 2 s; crossing midnight counted at begin hour
        report("r3", 0, "u3", "d1", [("com.a", BASE_MS + 23 * h, BASE_MS + 23 * h + 1999, "1.0", "game"),
                                     ("com.a", BASE_MS + 23 * h + 5000, BASE_MS + 25 * h, "1.1", "game")]),
        # same user-day twice: the later report wins for user metrics
        report("r4", 0, "u4", "d1", [("com.b", BASE_MS, BASE_MS + 1000, "1.0", "news")]),
        report("r5", 1, "u4", "d1", [("com.c", BASE_MS + h, BASE_MS + h + 7000, "2.0", "tool"),
                                     ("com.b", BASE_MS + 2 * h, BASE_MS + 2 * h + 3000, "1.0", "news")]),
    ]
    return Usage.from_reports(reports_df(spark, data))


def test_report_grain_counts_include_empty(spark):
    u = _usage(spark)
    assert rows(device.device_counts(u.facts, "brand")) == [("d1", "B", 5)]
    prov = dict((r["province"], r["n"]) for r in population.group_province(u.facts).collect())
    assert prov["P1"] == 1 and prov["P"] == 4
    b = dict((r["bucket"], r["n"]) for r in population.group_usage_bucket(u.facts).collect())
    # totals in ms fed to second thresholds: 0 -> "1"; -1500 -> "6";
    # 1000 (first u4 report) -> "3"; the others are >= 7200 -> "6"
    assert b == {"1": 1, "3": 1, "6": 3}


def test_user_day_last_report_and_empty_text(spark):
    u = _usage(spark)
    cnt = dict(((r["user_id"]), r["sessions"]) for r in user.user_day_session_count(u.facts).collect())
    assert cnt == {"u1": 0, "u2": 1, "u3": 2, "u4": 2}
    hist = dict((r["user_id"], r["history_text"]) for r in user.user_day_history_text(u.sessions, u.facts).collect())
    assert hist["u1"] == ""
    assert hist["u4"] == f"com.c:{BASE_MS + 3600_000},com.b:{BASE_MS + 7200_000}"
    stat = dict((r["user_id"], r["usage_text"]) for r in user.user_day_app_duration_text(u.sessions, u.facts).collect())
    assert stat["u1"] == "" and stat["u4"] == "com.b:3000,com.c:7000"
    ms = dict((r["user_id"], r["duration_ms"]) for r in user.user_day_duration_ms(u.facts).collect())
    assert ms["u2"] == -1500 and ms["u1"] == 0


def test_app_seconds_and_buckets(spark):
    u = _usage(spark)
    secs = dict(((r["package_name"]), r["seconds"]) for r in app.app_duration_seconds(u.sessions).collect())
    # com.a: -1 (negative span) + 1 + (2h - 5 s) = 7194
    assert secs["com.a"] == -1 + 1 + (7200 - 5)
    b = rows(app.app_usage_buckets(u.sessions), "package_name", "bucket", "n")
    assert ("com.a", "6", 1) in b and ("com.a", "5", 1) in b
    assert ("com.b", "1", 2) in b


def test_hour_of_midnight_crossing(spark):
    u = _usage(spark)
    hours = rows(app.app_hour_profile(u.sessions).filter("package_name = 'com.a'"), "hour", "n")
    assert (23, 2) in hours and (0, 1) in hours


def test_launches_and_users(spark):
    u = _usage(spark)
    assert dict((r["package_name"], r["n"]) for r in app.app_launches(u.sessions).collect()) == \
        {"com.a": 3, "com.b": 2, "com.c": 1}
    assert dict((r["package_name"], r["users"]) for r in app.app_daily_user_count(u.sessions).collect()) == \
        {"com.a": 2, "com.b": 1, "com.c": 1}
    t = app.app_daily_users_text(u.sessions, pages=1).filter("package_name = 'com.a'").first()
    assert t["users_text"] == "u2,u3" and t["page"] == 0


def test_users_text_pages_cover_all_users(spark):
    data = [report(f"r{i}", 0, f"u{i:03d}", "d1", [("com.z", BASE_MS, BASE_MS + 1, "1.0", "k")])
            for i in range(250)]
    u = Usage.from_reports(reports_df(spark, data))
    pages = app.app_daily_users_text(u.sessions, pages=8).collect()
    assert len(pages) == 8
    members = [m for p in pages for m in p["users_text"].split(",")]
    assert sorted(members) == [f"u{i:03d}" for i in range(250)]
    # a user's page does not depend on the group's size
    few = app.app_daily_users_text(u.sessions.filter("user_id < 'u020'"), pages=8).collect()
    page = {m: p["page"] for p in pages for m in p["users_text"].split(",")}
    assert all(page[m] == p["page"] for p in few for m in p["users_text"].split(","))


def test_history_is_one_text_whatever_the_session_numbers(spark):
    apps = [(f"com.p{i % 3}", BASE_MS + i, BASE_MS + i + 10, "1.0", "k") for i in range(7)]
    u = Usage.from_reports(reports_df(spark, [report("r1", 0, "u1", "d1", apps)]))
    s = u.sessions.withColumn("session_seq", F.col("session_seq") + 99_997)  # on both sides of 100,000
    rows_ = user.user_day_history_text(s, u.facts).collect()
    assert len(rows_) == 1 and rows_[0]["history_text"] == ",".join(f"{a[0]}:{a[1]}" for a in apps)
    assert user.user_day_history_text(s).collect() == rows_
