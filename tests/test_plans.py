"""Plans that should hold at any scale: no join or shuffle that a query does not need."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL


def _plan(spark, key):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = E.queries()[key](spark, SF_SMALL)
        return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _count(plan, node):
    return len(re.findall(rf"[ +:-]{node}\b", plan))


@pytest.mark.parametrize("key", ["app_launches", "app_daily_users", "app_daily_users_text", "app_version_launches",
                                 "app_hour_profile", "user_interest", "group_interest", "group_hour_profile"])
def test_one_exchange_and_no_join(spark, key):
    plan = _plan(spark, key)
    assert "Join" not in plan and _count(plan, "Exchange") == 1


@pytest.mark.parametrize("key", ["user_day_duration_ms", "user_day_session_count", "user_day_app_duration",
                                 "user_day_app_duration_text", "user_day_history", "user_day_history_text"])
def test_last_report_takes_two_exchanges(spark, key):
    plan = _plan(spark, key)
    assert "Join" not in plan and "Scan ExistingRDD" not in plan and _count(plan, "Exchange") <= 2


def test_device_counts_group_only_what_they_use(spark):
    plan = _plan(spark, "aiv_brand")
    keys = re.search(r"HashAggregate\(keys=\[([^\]]*report_id[^\]]*)\]", plan).group(1)
    assert sorted(re.sub(r"#\d+", "", k).strip() for k in keys.split(",")) == ["brand", "date", "report_id"]
