"""DuckDB oracle SQL for every checked query.

Each statement starts from the same fixture (FIXTURES.md) written
independently in DuckDB's dialect, so a Spark result is compared against a
second engine, not against itself.  Column names and types are aliased and
cast to match the Spark side exactly.
"""

from __future__ import annotations

BASE = """
WITH s AS (
  SELECT e.event_id, e.user_id, CAST(e.user_id AS VARCHAR) AS uid,
         strftime(e.ts, '%Y-%m-%d') AS date, e.event_id % 2 AS slot,
         epoch_us(e.ts) // 1000 AS begin_ms,
         epoch_us(e.ts) // 1000 + CAST(round(e.value * 100) AS BIGINT) * 300 AS end_ms,
         e.event_type AS kind, CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS k
  FROM events e),
sessions AS (
  SELECT concat(s.uid, '-', s.date, '-', CAST(s.slot AS VARCHAR)) AS report_id,
         s.slot AS ingest_seq, s.uid AS user_id, n.n_name AS province, r.r_name AS city, s.date,
         s.event_id AS session_seq,
         concat('com.', s.kind, '.a', CAST(s.k % 8 AS VARCHAR)) AS package_name,
         s.begin_ms AS begin_time, s.end_ms AS end_time,
         CASE s.k % 5 WHEN 0 THEN '1.0' WHEN 1 THEN '1.1' WHEN 2 THEN '2.0'
                      WHEN 3 THEN '3.0' ELSE '4.0' END AS version,
         s.kind, p.p_brand AS brand, p.p_name AS model, c.c_mktsegment AS language,
         concat('os', CAST(p.p_size % 6 AS VARCHAR)) AS system_version,
         concat(CAST(p.p_size AS VARCHAR), 'x', CAST(p.p_size * 2 AS VARCHAR)) AS resolution,
         CASE s.user_id % 3 WHEN 0 THEN 'wifi' WHEN 1 THEN '4g' ELSE '3g' END AS net_status,
         concat('isp', CAST(s.user_id % 4 AS VARCHAR)) AS isp
  FROM s JOIN customer c ON c.c_custkey = s.user_id
         JOIN nation n ON n.n_nationkey = c.c_nationkey
         JOIN region r ON r.r_regionkey = n.n_regionkey
         JOIN part p ON p.p_partkey = s.user_id),
facts AS (
  SELECT report_id, ingest_seq, user_id, province, city, date, brand, model, language,
         system_version, resolution, net_status, isp,
         CAST(count(*) AS BIGINT) AS sessions,
         CAST(sum(end_time - begin_time) AS BIGINT) AS duration_ms
  FROM sessions GROUP BY ALL),
last AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, date
                                 ORDER BY ingest_seq DESC, report_id DESC) AS rn
    FROM facts) WHERE rn = 1)
"""


def bucket(v: str) -> str:
    return (f"CASE WHEN {v} >= 0 AND {v} < 300 THEN '1' WHEN {v} >= 300 AND {v} < 900 THEN '2' "
            f"WHEN {v} >= 900 AND {v} < 1800 THEN '3' WHEN {v} >= 1800 AND {v} < 3600 THEN '4' "
            f"WHEN {v} >= 3600 AND {v} < 7200 THEN '5' ELSE '6' END")


HOUR = "CAST(hour(make_timestamp(begin_time * 1000)) AS INTEGER)"
_D = "CAST(make_timestamp(begin_time * 1000) AS DATE)"
WEEK = f"CAST(ceil((day({_D}) + dayofweek(date_trunc('month', {_D}))) / 7.0) AS INTEGER)"
SECS = "(end_time - begin_time) // 1000"


def _device(dim: str) -> str:
    return f"SELECT date, {dim}, CAST(count(*) AS BIGINT) AS n FROM facts GROUP BY date, {dim}"


BODIES = {
    "aiv_brand": _device("brand"),
    "aiv_model": _device("model"),
    "aiv_system_version": _device("system_version"),
    "aiv_resolution": _device("resolution"),
    "aiv_net_status": _device("net_status"),
    "aiv_isp": _device("isp"),
    "aiv_all": """
      SELECT date, dimension, value, CAST(count(*) AS BIGINT) AS n FROM (
        SELECT date, 'brand' AS dimension, brand AS value FROM facts UNION ALL
        SELECT date, 'model', model FROM facts UNION ALL
        SELECT date, 'system_version', system_version FROM facts UNION ALL
        SELECT date, 'resolution', resolution FROM facts UNION ALL
        SELECT date, 'net_status', net_status FROM facts UNION ALL
        SELECT date, 'isp', isp FROM facts) GROUP BY ALL""",
    "app_launches": "SELECT package_name, date, CAST(count(*) AS BIGINT) AS n FROM sessions GROUP BY ALL",
    "app_daily_users": "SELECT DISTINCT package_name, date, user_id FROM sessions",
    "app_daily_user_count": """
      SELECT package_name, date, CAST(count(DISTINCT user_id) AS BIGINT) AS users
      FROM sessions GROUP BY ALL""",
    "app_daily_users_text": """
      , u AS (SELECT DISTINCT package_name, date, user_id FROM sessions)
      SELECT package_name, date, page, string_agg(user_id, ',' ORDER BY user_id) AS users_text
      FROM (SELECT u.*, CAST('0x' || substr(md5(u.user_id), 1, 8) AS BIGINT) % 64 AS page FROM u)
      GROUP BY package_name, date, page""",
    "app_version_index": "SELECT DISTINCT package_name, version FROM sessions",
    "app_version_launches": """
      SELECT package_name, version, date, CAST(count(*) AS BIGINT) AS n FROM sessions GROUP BY ALL""",
    "app_duration_seconds": f"""
      SELECT package_name, date, CAST(sum({SECS}) AS BIGINT) AS seconds FROM sessions GROUP BY ALL""",
    "app_usage_buckets": f"""
      SELECT package_name, {bucket('secs')} AS bucket, date, CAST(count(*) AS BIGINT) AS n
      FROM (SELECT report_id, date, package_name, sum({SECS}) AS secs
            FROM sessions GROUP BY report_id, date, package_name)
      GROUP BY ALL""",
    "app_hour_profile": f"""
      SELECT package_name, {HOUR} AS hour, CAST(count(*) AS BIGINT) AS n FROM sessions GROUP BY ALL""",
    "app_week_profile": f"""
      SELECT package_name, {WEEK} AS week_of_month, CAST(count(*) AS BIGINT) AS n
      FROM sessions GROUP BY ALL""",
    "user_interest": "SELECT user_id, kind, CAST(count(*) AS BIGINT) AS n FROM sessions GROUP BY ALL",
    "user_day_duration_ms": "SELECT user_id, date, duration_ms FROM last",
    "user_day_session_count": "SELECT user_id, date, sessions FROM last",
    "user_day_app_duration": """
      SELECT s.user_id, s.date, s.package_name, CAST(sum(s.end_time - s.begin_time) AS BIGINT) AS duration_ms
      FROM sessions s JOIN last l ON s.report_id = l.report_id
      GROUP BY s.user_id, s.date, s.package_name""",
    "user_day_app_duration_text": """
      SELECT l.user_id, l.date,
             coalesce(string_agg(a.package_name || ':' || CAST(a.ms AS VARCHAR), ','
                                 ORDER BY a.package_name), '') AS usage_text
      FROM last l LEFT JOIN (
        SELECT report_id, package_name, sum(end_time - begin_time) AS ms
        FROM sessions GROUP BY report_id, package_name) a ON a.report_id = l.report_id
      GROUP BY l.user_id, l.date""",
    "user_day_history": """
      SELECT s.user_id, s.date, s.session_seq, s.package_name, s.begin_time
      FROM sessions s JOIN last l ON s.report_id = l.report_id""",
    "user_day_history_text": """
      SELECT l.user_id, l.date,
             coalesce(string_agg(s.package_name || ':' || CAST(s.begin_time AS VARCHAR), ','
                                 ORDER BY s.session_seq), '') AS history_text
      FROM last l LEFT JOIN sessions s ON s.report_id = l.report_id
      GROUP BY l.user_id, l.date""",
    "group_interest": "SELECT date, kind, CAST(count(*) AS BIGINT) AS n FROM sessions GROUP BY ALL",
    "group_province": "SELECT date, province, CAST(count(*) AS BIGINT) AS n FROM facts GROUP BY ALL",
    "group_usage_bucket": f"""
      SELECT date, {bucket('duration_ms')} AS bucket, CAST(count(*) AS BIGINT) AS n
      FROM facts GROUP BY ALL""",
    "group_hour_profile": f"""
      SELECT date, {HOUR} AS hour, CAST(count(*) AS BIGINT) AS n FROM sessions GROUP BY ALL""",
    "conditional_share": """
      SELECT CAST(count(*) FILTER (WHERE net_status = 'wifi') AS BIGINT) AS hits,
             CAST(count(*) AS BIGINT) AS total FROM facts""",
    "reports_encode": """
      SELECT report_id, CAST(to_json(struct_pack(
               user_id := user_id, province := province, city := city, date := date,
               apps := apps, brand := brand, model := model, language := language,
               system_version := system_version, resolution := resolution,
               net_status := net_status, ISP := isp)) AS VARCHAR) AS value
      FROM (SELECT report_id, user_id, province, city, date, brand, model, language,
                   system_version, resolution, net_status, isp,
                   list(struct_pack(package_name := package_name, beginTime := begin_time,
                                    endTime := end_time, version := version, kind := kind)
                        ORDER BY session_seq) AS apps
            FROM sessions GROUP BY ALL)""",
    "reports_decode": """
      SELECT report_id, user_id, province, city, date, brand, model, language, system_version,
             resolution, net_status, isp, sessions, duration_ms FROM facts""",
    "decode_status_counts": """
      SELECT status, CAST(count(*) AS BIGINT) AS lines FROM (
        SELECT 1 AS status FROM facts UNION ALL
        SELECT CASE WHEN json_valid(props) THEN 0 ELSE -1 END FROM events UNION ALL
        SELECT CASE WHEN json_valid(p_name) THEN 0 ELSE -1 END FROM part) GROUP BY status""",
    "sessions_explode": """
      SELECT report_id, user_id, date,
             CAST(row_number() OVER (PARTITION BY report_id ORDER BY session_seq) - 1 AS BIGINT)
               AS session_seq,
             package_name, begin_time, end_time, version, kind
      FROM sessions""",
}


def _cells_sum() -> str:
    ses = [
        ("'SINGLE_APP'", "package_name", "'click_num'", "date", "count(*)"),
        ("'APP_VERSION'", "package_name || '_' || version", "'click_num'", "date", "count(*)"),
        ("'SINGLE_APP'", "package_name", "'duration'", "date", f"sum({SECS})"),
        ("'SINGLE_APP'", "package_name", "'day_period'", f"CAST({HOUR} AS VARCHAR)", "count(*)"),
        ("'SINGLE_APP'", "package_name", "'week_period'", f"CAST({WEEK} AS VARCHAR)", "count(*)"),
        ("'USER'", "user_id", "'hobby'", "kind", "count(*)"),
        ("'USER_GROUP'", "date", "'hobby'", "kind", "count(*)"),
        ("'USER_GROUP'", "date", "'period'", f"CAST({HOUR} AS VARCHAR)", "count(*)"),
    ]
    rep = [("'AIV'", "date", f"'{fam}'", col, "count(*)") for col, fam in (
        ("brand", "brand"), ("model", "model"), ("system_version", "system_version"),
        ("resolution", "resolution"), ("net_status", "net_status"), ("isp", "ISP"))]
    rep += [("'USER_GROUP'", "date", "'location'", "province", "count(*)"),
            ("'USER_GROUP'", "date", "'usage'", bucket("duration_ms"), "count(*)")]
    parts = [f"SELECT {t}, {r}, {f}, {q}, {v} FROM sessions GROUP BY 1, 2, 3, 4" for t, r, f, q, v in ses]
    parts += [f"SELECT {t}, {r}, {f}, {q}, {v} FROM facts GROUP BY 1, 2, 3, 4" for t, r, f, q, v in rep]
    parts.append(f"""SELECT 'APP_USAGE', package_name, {bucket('secs')}, date, count(*)
        FROM (SELECT report_id, date, package_name, sum({SECS}) AS secs
              FROM sessions GROUP BY report_id, date, package_name) GROUP BY 1, 2, 3, 4""")
    body = "\n      UNION ALL ".join(parts)
    return f"""
      SELECT tbl, row_key, family, qualifier, CAST(value AS BIGINT) AS value FROM (
        SELECT NULL::VARCHAR AS tbl, NULL::VARCHAR AS row_key, NULL::VARCHAR AS family,
               NULL::VARCHAR AS qualifier, NULL::HUGEINT AS value WHERE false
        UNION ALL {body})"""


BODIES["merge_sum"] = _cells_sum()
BODIES["merge_union"] = """
      SELECT DISTINCT 'SINGLE_APP' AS tbl, package_name AS row_key, 'user' AS family,
             date AS qualifier, user_id AS member FROM sessions"""
BODIES["merge_last"] = f"""
      SELECT DISTINCT 'SINGLE_APP' AS tbl, package_name AS row_key, 'version' AS family,
             version AS qualifier, version AS value FROM sessions
      UNION ALL SELECT 'USER', user_id, 'usage_duration', date, CAST(duration_ms AS VARCHAR) FROM last
      UNION ALL SELECT 'USER', user_id, 'usage_times', date, CAST(sessions AS VARCHAR) FROM last
      UNION ALL SELECT 'USER', user_id, 'usage_statistics', date, usage_text FROM (
        {BODIES['user_day_app_duration_text']})
      UNION ALL SELECT 'USER', l.user_id, 'usage_history', l.date,
             coalesce(string_agg(s.package_name || ':' || CAST(s.begin_time AS VARCHAR), ','
                                 ORDER BY s.session_seq), '')
      FROM last l LEFT JOIN sessions s ON s.report_id = l.report_id GROUP BY l.user_id, l.date"""


def _launch_cells(value: str, where: str = "true", having: str = "true") -> str:
    return f"""
      SELECT package_name AS row_key, 'click_num' AS family, date AS qualifier, 'SUM' AS law,
             CAST({value} AS VARCHAR) AS value
      FROM sessions WHERE {where} GROUP BY package_name, date HAVING {having}"""


_SLOT0 = "count(*) FILTER (WHERE ingest_seq = 0)"
_ROW = "package_name = 'com.click.a1'"
BODIES["cell_scan"] = _launch_cells("count(*)")
BODIES["cell_get"] = _launch_cells("count(*)", _ROW)
BODIES["cell_put"] = _launch_cells(
    f"CASE WHEN package_name LIKE 'com.click.%' THEN 7 ELSE count(*) END + {_SLOT0}")
BODIES["cell_put_row"] = _launch_cells("count(*)", f"{_ROW} AND ingest_seq = 0") + """
      UNION ALL SELECT 'com.click.a1', 'click_num', '2099-01-01', 'SUM', '100'
      UNION ALL SELECT 'com.click.a1', 'click_num', '2099-01-02', 'SUM', '300'"""
BODIES["cell_delete_row"] = _launch_cells("count(*)", f"NOT ({_ROW} AND ingest_seq = 0)")
BODIES["table_drop"] = _launch_cells("count(*)", "ingest_seq = 1")
BODIES["merge_maps"] = BODIES["app_launches"]
BODIES["app_daily_user_estimate"] = """
      SELECT package_name, date, CAST(count(DISTINCT user_id) AS BIGINT) AS users, true AS merged_is_one_pass,
             true AS within_bound FROM sessions GROUP BY package_name, date"""
BODIES["sum_state"] = BODIES["merge_sum"]
BODIES["stream_status_counts"] = """
      SELECT 0::BIGINT AS batch_id, count(*) AS accepted, 0::BIGINT AS nonconforming, 0::BIGINT AS malformed FROM facts
      UNION ALL SELECT 1, 0, count(*), 0 FROM events
      UNION ALL SELECT 2, 0, 0, count(*) FROM part"""
BODIES["batch_sink"] = f"""
      SELECT tbl, row_key, family, qualifier, 'SUM' AS law, CAST(value AS VARCHAR) AS value FROM ({_cells_sum()})
      UNION ALL SELECT tbl, row_key, family, qualifier, 'UNION', member FROM ({BODIES['merge_union']})
      UNION ALL SELECT tbl, row_key, family, qualifier, 'LAST', value FROM ({BODIES['merge_last']})"""

BODIES["cell_table_sql"] = f"""
      SELECT row_key, family, qualifier, law, value FROM ({BODIES['batch_sink']}) WHERE tbl = 'SINGLE_APP'"""


def sql_for(key: str) -> str:
    body = BODIES[key].strip()
    if body.startswith(","):
        # the body adds its own CTEs after the shared ones
        return BASE.rstrip() + "\n" + body
    return BASE + body


# Draw queries do not need the usage fixture.
_BRAND_MODEL = """
WITH w AS (SELECT p_brand AS brand, p_type AS model, CAST(count(*) AS BIGINT) AS weight
           FROM part GROUP BY ALL),
cum AS (SELECT brand, model, weight,
               CAST(sum(weight) OVER (ORDER BY brand, model ROWS UNBOUNDED PRECEDING) AS BIGINT) AS hi
        FROM w)
"""

DRAWS = {
    "table_create": """
      SELECT CAST(o_custkey AS VARCHAR) AS row_key, 'status' AS family, o_orderstatus AS qualifier, 'SUM' AS law,
             CAST(count(*) AS VARCHAR) AS value FROM orders GROUP BY o_custkey, o_orderstatus""",
    "weight_rollup": """
      SELECT p_brand AS brand, CAST(count(*) AS BIGINT) AS weight FROM part GROUP BY ALL""",
    "weight_cumulative": _BRAND_MODEL + "SELECT brand, model, weight, hi - weight AS lo, hi FROM cum",
    "hierarchical_draw": _BRAND_MODEL + """,
      pb AS (SELECT brand, sum(weight) AS bw FROM w GROUP BY brand),
      pc AS (SELECT brand, bw,
                    CAST(sum(bw) OVER (ORDER BY brand ROWS UNBOUNDED PRECEDING) AS BIGINT) AS bhi
             FROM pb),
      tot AS (SELECT sum(weight) AS total FROM w),
      d AS (SELECT o_orderkey, CAST((o_orderkey * 7919) % tot.total + 1 AS BIGINT) AS r FROM orders, tot),
      d1 AS (SELECT d.o_orderkey, d.r, pc.brand,
                    pc.bhi - pc.bw + (d.o_orderkey * 104729) % pc.bw + 1 AS r2
             FROM d JOIN pc ON d.r > pc.bhi - pc.bw AND d.r <= pc.bhi)
      SELECT d1.o_orderkey, d1.r, d1.brand, cum.model
      FROM d1 JOIN cum ON cum.brand = d1.brand AND d1.r2 > cum.hi - cum.weight AND d1.r2 <= cum.hi""",
    "weighted_draw": """
      , w AS (SELECT package_name, kind, CAST(count(*) AS BIGINT) AS weight FROM sessions GROUP BY ALL),
      cum AS (SELECT package_name, kind, weight,
                     sum(weight) OVER (ORDER BY package_name, kind ROWS UNBOUNDED PRECEDING) AS hi
              FROM w),
      tot AS (SELECT sum(weight) AS total FROM w),
      d AS (SELECT o_orderkey, CAST((o_orderkey * 7919) % tot.total + 1 AS BIGINT) AS r FROM orders, tot)
      SELECT d.o_orderkey, d.r, cum.package_name, cum.kind
      FROM d JOIN cum ON d.r > cum.hi - cum.weight AND d.r <= cum.hi""",
    "uniform_draw": """
      WITH u AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS hi FROM customer),
      tot AS (SELECT count(*) AS total FROM customer),
      d AS (SELECT o_orderkey, CAST((o_orderkey * 7919) % tot.total + 1 AS BIGINT) AS r FROM orders, tot)
      SELECT d.o_orderkey, d.r, u.c_custkey FROM d JOIN u ON d.r = u.hi""",
}


_SPAN = 16 ** 15


def _uniform(n: str, key: str, stream: str, seed: int = 20) -> str:
    """The counter-based generator in DuckDB's arithmetic."""
    v = [f"CAST(concat('0x', substr(md5(concat('{seed}|{stream}|0|', CAST({key} AS VARCHAR))), {at}, 15)) AS BIGINT)"
         for at in (1, 16)]
    tries = " ".join(f"WHEN {x} < {_SPAN} - {_SPAN} % {n} THEN {x} % {n}" for x in v)
    return f"CAST(CASE {tries} ELSE {v[-1]} % {n} END AS BIGINT)"


def _alias(name: str, source: str, keys: str, parent: str = "0") -> str:
    """CTEs of an alias table ``name``; light and heavy categories are matched by as-of joins."""
    k = [c.strip() for c in keys.split(",")]
    part = f"PARTITION BY {parent}"
    run = f"OVER ({part} ORDER BY {keys} ROWS UNBOUNDED PRECEDING)"
    a = ", ".join(f"h.{c} AS alias_{c}" for c in k)
    none = ", ".join(f"CAST(NULL AS VARCHAR) AS alias_{c}" for c in k)
    step = ", ".join(f"CASE WHEN l.stop > d.heavy THEN d.next_{c} END AS alias_{c}" for c in k)
    following = ", ".join(f"lead({c}) OVER ({part} ORDER BY heavy) AS next_{c}" for c in k)
    head = f"d.g, d.slot, {', '.join('d.' + c for c in k)}, d.weight"
    return f"""
      {name}_w AS (SELECT *, {parent} AS g, CAST(count(*) OVER ({part}) AS HUGEINT) AS n,
                          CAST(sum(weight) OVER ({part}) AS HUGEINT) AS total,
                          row_number() OVER ({part} ORDER BY {keys}) - 1 AS slot FROM {source}),
      {name}_d AS (SELECT *, weight * n - total AS over, sum(greatest(total - weight * n, 0)) {run} AS light,
                          sum(greatest(weight * n - total, 0)) {run} AS heavy FROM {name}_w),
      {name}_h AS (SELECT *, {following} FROM {name}_d WHERE over > 0),
      {name}_l AS (SELECT g, light AS stop, light + over AS start FROM {name}_d WHERE over < 0),
      {name} AS (
        SELECT {head}, CAST(d.weight * d.n AS BIGINT) AS own, {a}, CAST(d.n AS BIGINT) AS n, CAST(d.total AS BIGINT) AS total
        FROM (SELECT *, light + over AS start FROM {name}_d WHERE over < 0) d ASOF JOIN {name}_h h ON d.g = h.g AND d.start < h.heavy
        UNION ALL
        SELECT {head}, CAST(d.total - (l.stop - d.heavy) AS BIGINT), {step}, CAST(d.n AS BIGINT), CAST(d.total AS BIGINT)
        FROM {name}_h d ASOF JOIN {name}_l l ON d.g = l.g AND d.heavy > l.start
        UNION ALL
        SELECT {head}, CAST(d.total AS BIGINT), {none}, CAST(d.n AS BIGINT), CAST(d.total AS BIGINT) FROM {name}_d d WHERE over = 0)"""


_W = "WITH w AS (SELECT p_brand AS brand, p_type AS model, CAST(count(*) AS BIGINT) AS weight FROM part GROUP BY ALL),"
DRAWS |= {
    "random_int": f"""
      SELECT o_orderkey, {_uniform('n', 'o_orderkey', 'customer')} AS r
      FROM orders, (SELECT count(*) AS n FROM customer)""",
    "alias_table": f"""{_W}{_alias('t', 'w', 'brand, model')}
      SELECT slot, brand, model, weight, own, alias_brand, alias_model, n, total FROM t""",
    "alias_table_by_brand": f"""{_W}{_alias('t', 'w', 'model', 'brand')}
      SELECT g AS brand, slot, model, weight, own, alias_model, n, total FROM t""",
    "alias_draw": f""",
      w AS (SELECT package_name, kind, CAST(count(*) AS BIGINT) AS weight FROM sessions GROUP BY ALL),
      {_alias('t', 'w', 'package_name, kind')},
      size AS (SELECT max(n) AS n, max(total) AS total FROM t),
      d AS (SELECT o_orderkey, {_uniform('n', 'o_orderkey', 'draw/slot')} AS slot,
                   {_uniform('total', 'o_orderkey', 'draw/mass')} AS mass FROM orders, size)
      SELECT o_orderkey, CASE WHEN mass < own THEN package_name ELSE alias_package_name END AS package_name,
             CASE WHEN mass < own THEN kind ELSE alias_kind END AS kind FROM d JOIN t ON t.slot = d.slot""",
    "alias_hierarchical_draw": f"""{_W}
      p AS (SELECT brand, CAST(sum(weight) AS BIGINT) AS weight, count(*) AS kids FROM w GROUP BY brand),
      size AS (SELECT count(*) AS n, CAST(sum(weight) AS BIGINT) AS total, CAST(sum(kids) AS BIGINT) AS leaves FROM p),
      c AS (SELECT brand, weight AS bw, kids,
                   CAST((CAST(weight AS HUGEINT) * leaves + kids * total - 1) // (kids * total) AS BIGINT) AS copies FROM p, size),
      {_alias('tp', 'p', 'brand')},
      {_alias('tc', 'w', 'model', 'brand')},
      d AS (SELECT o_orderkey, {_uniform('n', 'o_orderkey', 'parent/slot')} AS slot,
                   {_uniform('total', 'o_orderkey', 'parent/mass')} AS mass FROM orders, size),
      e AS (SELECT o_orderkey, CASE WHEN mass < own THEN brand ELSE alias_brand END AS brand FROM d JOIN tp ON tp.slot = d.slot),
      f AS (SELECT o_orderkey, e.brand, {_uniform('(kids * copies)', 'o_orderkey', 'child/slot')} % kids AS slot,
                   {_uniform('bw', 'o_orderkey', 'child/mass')} AS mass FROM e JOIN c ON c.brand = e.brand)
      SELECT o_orderkey, f.brand, CASE WHEN mass < own THEN model ELSE alias_model END AS model
      FROM f JOIN tc ON tc.g = f.brand AND tc.slot = f.slot""",
}


def oracle_sql() -> dict[str, str]:
    out = {k: sql_for(k) for k in BODIES}
    for k, v in DRAWS.items():
        out[k] = (BASE.rstrip() + "\n" + v.strip()) if v.strip().startswith(",") else v
    return out
