import datetime as dt

from pyspark.sql import functions as F

from usagelake.functions.expressions import duration_bucket, hour_of, trunc_seconds, week_of_month


def _ms(y, m, d, h=0):
    return int(dt.datetime(y, m, d, h, tzinfo=dt.timezone.utc).timestamp() * 1000)


def test_bucket_borders(spark):
    vals = [299, 300, 899, 900, 1799, 1800, 3599, 3600, 7199, 7200, -1, 0]
    df = spark.createDataFrame([(v,) for v in vals], "v long")
    got = [r[0] for r in df.select(duration_bucket("v")).collect()]
    assert got == ["1", "2", "2", "3", "3", "4", "4", "5", "5", "6", "6", "1"]


def test_bucket_units(spark):
    df = spark.createDataFrame([(299_000,)], "v long")
    assert df.select(duration_bucket("v", "ms")).first()[0] == "6"
    assert df.select(duration_bucket("v", "ms_as_s")).first()[0] == "1"


def test_trunc_seconds_toward_zero(spark):
    df = spark.createDataFrame([(0, -1500), (0, 1999), (1000, 0)], "begin_time long, end_time long")
    assert [r[0] for r in df.select(trunc_seconds()).collect()] == [-1, 1, -1]


def test_two_sessions_of_1999ms_sum_to_2(spark):
    df = spark.createDataFrame([(0, 1999), (0, 1999)], "begin_time long, end_time long")
    assert df.agg(F.sum(trunc_seconds())).first()[0] == 2


def test_hour_and_zone(spark):
    ms = _ms(2018, 3, 10, 23)
    df = spark.createDataFrame([(ms,)], "t long")
    assert df.select(hour_of("t")).first()[0] == 23
    assert df.select(hour_of("t", "Asia/Shanghai")).first()[0] == 7
    # independent of the session time zone
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert df.select(hour_of("t")).first()[0] == 23
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_week_of_month_matches_calendar(spark):
    # Sunday-first weeks, week 1 holds the 1st; both dates fall in week 6.
    df = spark.createDataFrame([(_ms(2018, 9, 30),), (_ms(2018, 12, 30),), (_ms(2018, 3, 1),),
                                (_ms(2018, 3, 4),)], "t long")
    assert [r[0] for r in df.select(week_of_month("t")).collect()] == [6, 6, 1, 2]


def test_week_of_month_whole_year(spark):
    import calendar
    days = [dt.date(2018, 1, 1) + dt.timedelta(d) for d in range(365)]
    df = spark.createDataFrame([(_ms(d.year, d.month, d.day, 12),) for d in days], "t long")
    got = [r[0] for r in df.select(week_of_month("t")).collect()]
    cal = calendar.Calendar(firstweekday=6)  # Sunday first
    want = []
    for d in days:
        weeks = cal.monthdayscalendar(d.year, d.month)
        want.append(next(i + 1 for i, w in enumerate(weeks) if d.day in w))
    assert got == want
