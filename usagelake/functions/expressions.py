"""Scalar column expressions shared by the metrics.

All of them are built-in Catalyst expressions, so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Usage-duration bucket thresholds.  A value v falls in bucket
# "1" when 0 <= v < 300, "2" when 300 <= v < 900, "3" when 900 <= v < 1800,
# "4" when 1800 <= v < 3600, "5" when 3600 <= v < 7200, and in "6" otherwise
# (negative values included).  The app metric feeds seconds; the population
# metric historically feeds milliseconds to the same thresholds.
BUCKET_BOUNDS_S = (0, 300, 900, 1800, 3600, 7200)



# ---- SQL text builders -----------------------------------------------------
# The same rules as the Column helpers below, as SQL text over column names
# (or lambda variables).  A whole expression parses in one JVM call.

NTZ_EPOCH_SQL = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def bucket_sql(v: str, unit: str = "s") -> str:
    if unit == "ms_as_s":
        v = f"(({v}) div 1000)"
    elif unit not in ("s", "ms"):
        raise ValueError(f"unit must be 's', 'ms' or 'ms_as_s', not {unit!r}")
    b = BUCKET_BOUNDS_S
    arms = " ".join(f"WHEN {v} >= {b[i]} AND {v} < {b[i + 1]} THEN '{i + 1}'" for i in range(5))
    return f"CASE {arms} ELSE '6' END"


def trunc_seconds_sql(begin: str = "begin_time", end: str = "end_time") -> str:
    return f"(CAST({end} - {begin} AS BIGINT) div 1000)"


def local_time_sql(ms: str, tz: str = "UTC") -> str:
    ntz = f"timestampadd(MILLISECOND, {ms}, {NTZ_EPOCH_SQL})"
    if tz.upper() == "UTC":
        return ntz
    return f"convert_timezone('UTC', '{tz}', {ntz})"


def hour_sql(ms: str, tz: str = "UTC") -> str:
    return f"CAST(hour({local_time_sql(ms, tz)}) AS INT)"


def week_of_month_sql(ms: str, tz: str = "UTC") -> str:
    d = f"to_date({local_time_sql(ms, tz)})"
    return f"CAST(ceil((dayofmonth({d}) + dayofweek(trunc({d}, 'MM')) - 1) / 7.0) AS INT)"


def pair_text_sql(k: str, v: str) -> str:
    return f"concat({k}, ':', CAST({v} AS STRING))"


def _ntz_epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_div(num, den) -> Column:
    """SQL ``div``: integral division truncating toward zero."""
    den_col = den if isinstance(den, Column) else F.lit(den)
    return F.call_function("div", _c(num).cast("bigint"), den_col)


def session_ms(begin="begin_time", end="end_time") -> Column:
    """Untruncated session length in milliseconds."""
    return _c(end) - _c(begin)


def trunc_seconds(begin="begin_time", end="end_time") -> Column:
    """Whole seconds of one session, truncated toward zero (-1500 ms -> -1)."""
    if isinstance(begin, str) and isinstance(end, str):
        return F.expr(trunc_seconds_sql(begin, end))
    return int_div(session_ms(begin, end), 1000)


def duration_bucket(value, unit: str = "s") -> Column:
    """Six-way usage bucket as text "1".."6".

    ``value`` is in seconds for ``unit="s"``.  ``unit="ms"`` applies the
    thresholds to a millisecond value unchanged, which is the historical
    population metric; ``unit="ms_as_s"`` converts milliseconds to whole
    seconds first (the intended reading).
    """
    if isinstance(value, str):
        return F.expr(bucket_sql(value, unit))
    v = _c(value)
    if unit == "ms_as_s":
        v = int_div(v, 1000)
    elif unit not in ("s", "ms"):
        raise ValueError(f"unit must be 's', 'ms' or 'ms_as_s', not {unit!r}")
    b = BUCKET_BOUNDS_S
    expr = F.when((v >= b[0]) & (v < b[1]), "1")
    for i in range(1, 5):
        expr = expr.when((v >= b[i]) & (v < b[i + 1]), str(i + 1))
    return expr.otherwise("6")


def epoch_ms_of(ts) -> Column:
    """Epoch milliseconds of a TIMESTAMP_NTZ, truncating sub-millisecond digits.

    Independent of the session time zone.
    """
    return F.timestamp_diff("MILLISECOND", _ntz_epoch(), _c(ts))


def local_time(ms, tz: str = "UTC") -> Column:
    """Wall-clock TIMESTAMP_NTZ in zone ``tz`` of an epoch-millisecond value.

    Built from NTZ arithmetic plus ``convert_timezone`` so the result does not
    depend on ``spark.sql.session.timeZone``.
    """
    ntz = F.timestamp_add("MILLISECOND", _c(ms), _ntz_epoch())
    if tz.upper() == "UTC":
        return ntz
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), ntz)


def hour_of(ms, tz: str = "UTC") -> Column:
    """Hour of day 0..23 of an epoch-millisecond instant in zone ``tz``."""
    if isinstance(ms, str):
        return F.expr(hour_sql(ms, tz))
    return F.hour(local_time(ms, tz)).cast("int")


def week_of_month(ms, tz: str = "UTC") -> Column:
    """Week of month with weeks starting on Sunday and a 1-day minimal first week.

    Week 1 is the partial week holding the 1st; a month can reach week 6.
    """
    if isinstance(ms, str):
        return F.expr(week_of_month_sql(ms, tz))
    d = F.to_date(local_time(ms, tz))
    first_dow = F.dayofweek(F.trunc(d, "MM"))  # 1 = Sunday
    return F.ceil((F.dayofmonth(d) + first_dow - 1) / F.lit(7.0)).cast("int")


def pair_text(k, v) -> Column:
    """``k:v`` text used by the per-user renderings."""
    return F.concat(_c(k), F.lit(":"), _c(v).cast("string"))
