"""The SQL oracle: for each registered query, ANSI SQL that DuckDB runs on the same
tables (views ``events``, ``orders``, ``lineitem``, ``customer``, ``part``, ``nation`` …).

It is written independently of the Spark code: plain joins, ``row_number``,
``NOT EXISTS`` and ``GROUP BY`` over the source tables.
"""

from __future__ import annotations

from pulse.plans import params as P

D = P.DAY

# --- views of the driver tables (mirror pulse.sources.views) -------------------------

EV = "(SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"

STARTUP = f"""
SELECT 'mid_' || CAST(e.user_id AS VARCHAR) AS mid,
       CAST(e.user_id AS VARCHAR) AS uid,
       'shop_app' AS appid,
       n.n_name AS area,
       ['phone', 'tablet', 'desktop'][1 + e.user_id % 3] AS os,
       'channel_' || CAST(e.user_id % 11 AS VARCHAR) AS ch,
       'startup' AS logType,
       CAST(2 + e.k // 40 AS VARCHAR) || '.' || CAST(e.k % 5 AS VARCHAR) AS vs,
       strftime(e.ts, '%Y-%m-%d') AS logDate,
       strftime(e.ts, '%H') AS logHour,
       CAST(epoch_us(e.ts) // 1000 AS BIGINT) AS ts
FROM {EV} e
LEFT JOIN customer c ON c.c_custkey = e.user_id
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
WHERE e.event_type = 'view'
"""

DAU = f"""
SELECT mid, uid, appid, area, os, ch, logType, vs, logDate, logHour, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY mid, logDate
             ORDER BY ts, uid NULLS FIRST, appid NULLS FIRST, area NULLS FIRST, os NULLS FIRST,
                      ch NULLS FIRST, logType NULLS FIRST, vs NULLS FIRST, logHour NULLS FIRST) AS rn
  FROM ({STARTUP}) s) t
WHERE rn = 1
"""

ORDER_ROWS = f"""
SELECT CAST(e.event_id AS VARCHAR) AS id,
       COALESCE(CAST(c.c_nationkey AS VARCHAR), '') AS province_id,
       COALESCE(c.c_name, '') AS consignee,
       'comment_' || CAST(e.k AS VARCHAR) AS order_comment,
       '13' || lpad(CAST(e.user_id AS VARCHAR), 9, '0') AS consignee_tel,
       '1001' AS order_status,
       CASE WHEN e.k % 2 = 0 THEN '1' ELSE '2' END AS payment_way,
       CAST(e.user_id AS VARCHAR) AS user_id,
       'img/' || CAST(e.event_id AS VARCHAR) || '.jpg' AS img_url,
       CAST(e.value AS VARCHAR) AS total_amount,
       strftime(e.ts + INTERVAL 15 MINUTE, '%Y-%m-%d %H:%M:%S') AS expire_time,
       'addr_' || CAST(e.user_id AS VARCHAR) AS delivery_address,
       strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS create_time,
       '' AS operate_time, '' AS tracking_no, '' AS parent_order_id,
       'otn_' || CAST(e.event_id AS VARCHAR) AS out_trade_no,
       'item ' || CAST(e.k AS VARCHAR) AS trade_body
FROM {EV} e
LEFT JOIN customer c ON c.c_custkey = e.user_id
WHERE e.event_type = 'purchase'
"""

ORDER_INFO = f"SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount) FROM ({ORDER_ROWS}) r"

ORDERS = f"""
SELECT * REPLACE (substring(consignee_tel, 1, 3) || '****' || substring(consignee_tel, 8) AS consignee_tel),
       split_part(create_time, ' ', 1) AS create_date,
       NULLIF(split_part(split_part(create_time, ' ', 2), ':', 1), '') AS create_hour
FROM ({ORDER_INFO}) o
"""

DETAIL = """
SELECT CAST(l.l_orderkey AS VARCHAR) || '_' || CAST(l.l_linenumber AS VARCHAR) AS order_detail_id,
       CAST(l.l_orderkey AS VARCHAR) AS order_id,
       CAST(o.o_custkey AS VARCHAR) AS user_id,
       CAST(l.l_partkey AS VARCHAR) AS sku_id,
       CASE WHEN c.c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS user_gender,
       CAST(15 + c.c_custkey % 40 AS INTEGER) AS user_age,
       CAST(1 + c.c_custkey % 10 AS VARCHAR) AS user_level,
       p.p_retailprice AS sku_price,
       p.p_name AS sku_name,
       p.p_brand AS sku_tm_id,
       strftime(o.o_orderdate, '%Y-%m-%d') AS dt,
       l.l_quantity AS sku_num,
       l.l_extendedprice AS order_amount,
       n.n_name AS province
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN part p ON l.l_partkey = p.p_partkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

GRID = ("order_detail_id, order_id, user_id, sku_id, user_gender, user_age, user_level, "
        "sku_price, sku_name, sku_tm_id, dt")
GRID_ASC = ", ".join(f"{c.strip()} ASC NULLS FIRST" for c in GRID.split(","))

# Raw log line type: view -> startup, error -> no type, else event.
LINE_TYPE = "CASE WHEN event_type = 'view' THEN 'startup' WHEN event_type = 'error' THEN NULL ELSE 'event' END"

YDAY = f"strftime(DATE '{D}' - INTERVAL 1 DAY, '%Y-%m-%d')"


def _money(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def _kpis() -> str:
    return f"""
SELECT 1 AS ord, 'dau' AS id, '新增日活' AS name,
       CAST((SELECT COUNT(*) FROM ({DAU}) d WHERE logDate = '{D}') AS DOUBLE) AS value
UNION ALL
SELECT 2, 'new_mid', '新增设备',
       CAST((SELECT COUNT(*) FROM (SELECT mid, MIN(logDate) AS f FROM ({DAU}) d GROUP BY mid) x
             WHERE f = '{D}') AS DOUBLE)
UNION ALL
SELECT 3, 'order_amount', '新增交易额',
       (SELECT {_money('total_amount')} FROM ({ORDERS}) o WHERE create_date = '{D}')
"""


def _hours_filled(inner: str, cols: str) -> str:
    return f"""
SELECT lpad(CAST(h.i AS VARCHAR), 2, '0') AS logHour, {cols}
FROM range(24) h(i) LEFT JOIN ({inner}) x ON x.logHour = lpad(CAST(h.i AS VARCHAR), 2, '0')
"""


DAU_HOUR = f"SELECT logHour, COUNT(*) AS ct FROM ({DAU}) d WHERE logDate = '{D}' GROUP BY logHour"

PROVINCE_SALES = f"""
SELECT province, COUNT(DISTINCT order_id) AS orders, CAST(SUM(sku_num) AS DOUBLE) AS sku_num,
       {_money('order_amount')} AS amount
FROM ({DETAIL}) s GROUP BY province
"""


def _share(label: str) -> str:
    return f"""
SELECT name, value, ROUND(value * 100.0 / SUM(value) OVER (), 6) AS share FROM (
  SELECT {label} AS name, COUNT(*) AS value FROM ({DETAIL}) s GROUP BY 1) g
"""


def _hour_doc(src: str, date_col: str, hour_col: str, agg: str) -> str:
    return f"""
SELECT to_json({{'yesterday': COALESCE(map_from_entries(list({{'k': {hour_col}, 'v': v}} ORDER BY {hour_col})
                                          FILTER (WHERE {date_col} = {YDAY})), MAP {{}}),
                 'today': COALESCE(map_from_entries(list({{'k': {hour_col}, 'v': v}} ORDER BY {hour_col})
                                          FILTER (WHERE {date_col} = '{D}')), MAP {{}})}}) AS doc
FROM (SELECT {date_col}, {hour_col}, {agg} AS v FROM ({src}) s
      WHERE {date_col} IN ('{D}', {YDAY}) GROUP BY {date_col}, {hour_col}) g
"""


ORACLE_SQL: dict[str, str] = {
    # scans, sources, sinks
    "land_raw": f"""SELECT strftime(ts, '%Y-%m-%d') AS dt, {LINE_TYPE} AS log_type, COUNT(*) AS n
                     FROM events GROUP BY 1, 2""",
    "scan_by_date": f"SELECT * FROM ({DAU}) d WHERE logDate = '{D}'",
    # projections / functions
    "parse_startup": STARTUP,
    "parse_order": ORDER_INFO,
    "stamp_ingest_ts": f"SELECT CAST(event_id AS VARCHAR) AS key, CAST(epoch_us(ts) // 1000 AS BIGINT) AS ts, {LINE_TYPE} AS type FROM events",
    "epoch_to_date_hour": f"SELECT mid, ts, logDate, logHour FROM ({STARTUP}) s",
    "datetime_split": f"""SELECT id, create_time, split_part(create_time, ' ', 1) AS create_date,
                           NULLIF(split_part(split_part(create_time, ' ', 2), ':', 1), '') AS create_hour
                           FROM ({ORDER_INFO}) o""",
    "mask_phone": f"""SELECT id, substring(consignee_tel, 1, 3) || '****' || substring(consignee_tel, 8) AS consignee_tel
                       FROM ({ORDER_INFO}) o""",
    "cdc_after_image": f"""SELECT json_object('id', id, 'province_id', province_id, 'consignee', consignee,
        'order_comment', order_comment, 'consignee_tel', consignee_tel, 'order_status', order_status,
        'payment_way', payment_way, 'user_id', user_id, 'img_url', img_url, 'total_amount', total_amount,
        'expire_time', expire_time, 'delivery_address', delivery_address, 'create_time', create_time,
        'operate_time', operate_time, 'tracking_no', tracking_no, 'parent_order_id', parent_order_id,
        'out_trade_no', out_trade_no, 'trade_body', trade_body) AS value FROM ({ORDER_ROWS}) r""",
    "filter_cdc": """SELECT CAST(event_id AS VARCHAR) AS key, 'order_info' AS "table", 'INSERT' AS op,
                      CAST(1 AS INTEGER) AS n_rows FROM events WHERE event_type = 'purchase'""",
    "route_by_type": """SELECT CAST(event_id AS VARCHAR) AS key,
                         CASE WHEN event_type = 'view' THEN 'startup_log' ELSE 'event_log' END AS topic FROM events""",
    "filter_date": f"SELECT * FROM ({DAU}) d WHERE logDate = '{D}'",
    "shift_day": f"""SELECT DISTINCT logDate, strftime(CAST(logDate AS DATE) - INTERVAL 1 DAY, '%Y-%m-%d') AS prev_day
                      FROM ({STARTUP}) s""",
    "sink_projection": f"""SELECT mid AS MID, uid AS UID, appid AS APPID, area AS AREA, os AS OS, ch AS CH,
                            logType AS TYPE, vs AS VS, logDate AS LOGDATE, logHour AS LOGHOUR, ts AS TS
                            FROM ({DAU}) d""",
    "kv_fold": f"""SELECT to_json(map_from_entries(list({{'k': logHour, 'v': ct}} ORDER BY logHour))) AS doc
                    FROM ({DAU_HOUR}) h""",
    "keyword_filter": f"""SELECT {GRID} FROM ({DETAIL}) s
                           WHERE contains(lower(sku_name), 'ring') AND contains(lower(sku_name), 'red')""",
    # joins
    "anti_seen_today": f"""SELECT a.mid, a.logDate, a.logHour, a.ts FROM ({STARTUP}) a
                            WHERE a.logHour >= '{P.NOON}' AND NOT EXISTS (
                              SELECT 1 FROM ({STARTUP}) m WHERE m.logHour < '{P.NOON}'
                              AND m.mid = a.mid AND m.logDate = a.logDate)""",
    "flag_first_order": """SELECT id, user_id, create_time,
                            CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY create_time, id) = 1
                                 THEN '1' ELSE '0' END AS is_first_order
                            FROM (SELECT o_orderkey AS id, o_custkey AS user_id,
                                         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time FROM orders) o""",
    "align_days": _hours_filled(
        f"""SELECT logHour, COUNT(*) FILTER (WHERE logDate = {YDAY}) AS y, COUNT(*) FILTER (WHERE logDate = '{D}') AS t
            FROM ({DAU}) d WHERE logDate IN ('{D}', {YDAY}) GROUP BY logHour""",
        "COALESCE(x.y, 0) AS yesterday, COALESCE(x.t, 0) AS today"),
    "hour_spine": _hours_filled(DAU_HOUR, "COALESCE(x.ct, 0) AS ct"),
    "sale_detail_wide": DETAIL,
    "province_dim": f"""SELECT o.province_id, o.id, n.n_name AS province_name FROM ({ORDER_INFO}) o
                         LEFT JOIN nation n ON CAST(n.n_nationkey AS VARCHAR) = o.province_id""",
    # aggregations
    "dau_total": f"SELECT COUNT(*) AS dau FROM ({DAU}) d WHERE logDate = '{D}'",
    "dau_hour": DAU_HOUR,
    "order_amount": f"SELECT {_money('total_amount')} AS order_amount FROM ({ORDERS}) o WHERE create_date = '{D}'",
    "order_amount_hour": f"""SELECT create_hour, {_money('total_amount')} AS order_amount FROM ({ORDERS}) o
                              WHERE create_date = '{D}' GROUP BY create_hour""",
    "first_per_key": DAU,
    "first_per_key_rn": DAU,
    "new_mid": f"""SELECT COUNT(*) AS new_mid FROM (SELECT mid, MIN(logDate) AS f FROM ({DAU}) d GROUP BY mid) x
                    WHERE f = '{D}'""",
    "kpi_summary": _kpis(),
    "launch_count": f"SELECT logDate, COUNT(*) AS launches FROM ({STARTUP}) s GROUP BY logDate",
    "hourly_active": f"""SELECT strftime(ts, '%H') AS logHour, COUNT(DISTINCT 'mid_' || CAST(user_id AS VARCHAR)) AS active
                          FROM events WHERE strftime(ts, '%Y-%m-%d') = '{D}' GROUP BY 1""",
    "gender_share": _share("CASE user_gender WHEN 'M' THEN '男' WHEN 'F' THEN '女' END"),
    "age_share": _share("CASE WHEN user_age IS NULL THEN NULL WHEN user_age < 20 THEN '20岁以下' "
                        "WHEN user_age <= 30 THEN '20-30岁' ELSE '30岁以上' END"),
    "province_sales": PROVINCE_SALES,
    "sales_band": f"""SELECT province, sku_num AS value,
                       CAST(LEAST(GREATEST(FLOOR(sku_num / 100), 0), 5) AS INTEGER) AS band
                       FROM ({PROVINCE_SALES}) p""",
    "sku_rank": f"""SELECT sku_name AS name, CAST(SUM(sku_num) AS DOUBLE) AS num FROM ({DETAIL}) s
                     GROUP BY sku_name ORDER BY num DESC, name ASC LIMIT {P.TOP_N}""",
    # windows
    "cum_dau": f"""SELECT logHour, ct, SUM(ct) OVER (ORDER BY logHour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                    AS cum_ct FROM ({_hours_filled(DAU_HOUR, 'COALESCE(x.ct, 0) AS ct')}) f""",
    "day_over_day": f"""
        WITH daily AS (SELECT CAST(logDate AS DATE) AS d, COUNT(*) AS v FROM ({DAU}) x GROUP BY 1),
             cal AS (SELECT CAST(unnest(generate_series(MIN(d), MAX(d), INTERVAL 1 DAY)) AS DATE) AS d FROM daily),
             dense AS (SELECT cal.d, COALESCE(daily.v, 0) AS v FROM cal LEFT JOIN daily ON cal.d = daily.d)
        SELECT strftime(a.d, '%Y-%m-%d') AS logDate, CAST(a.v AS BIGINT) AS value, CAST(b.v AS BIGINT) AS prev_value,
               CASE WHEN b.v > 0 THEN ROUND((a.v - b.v) * 100.0 / b.v, 4) END AS pct_change
        FROM dense a LEFT JOIN dense b ON b.d = a.d - INTERVAL 1 DAY""",
    # sort / paging
    "paged_detail": f"""SELECT {GRID}, (SELECT COUNT(*) FROM ({DETAIL}) c) AS total FROM ({DETAIL}) s
                         ORDER BY {GRID_ASC} LIMIT {P.PAGE_LENGTH} OFFSET {P.PAGE_START}""",
    "detail_order_by": f"""SELECT {GRID} FROM ({DETAIL}) s
                            ORDER BY sku_price DESC NULLS LAST, user_age ASC NULLS FIRST,
                            {", ".join(f"{c.strip()} ASC NULLS FIRST" for c in GRID.split(",")
                                       if c.strip() not in ("sku_price", "user_age"))}
                            LIMIT {P.DETAIL_N}""",
    # documents
    "report_total": f"""SELECT '[' || string_agg(CASE WHEN value IS NULL THEN json_object('id', id, 'name', name)
                              ELSE json_object('id', id, 'name', name, 'value',
                                   CASE WHEN id IN ('dau', 'new_mid') THEN to_json(CAST(value AS BIGINT))
                                        ELSE to_json(value) END) END, ',' ORDER BY ord) || ']' AS doc
                         FROM ({_kpis()}) k""",
    "report_hour": f"""SELECT 'dau' AS id, doc FROM ({_hour_doc(DAU, 'logDate', 'logHour', 'COUNT(*)')}) a
                        UNION ALL
                        SELECT 'order_amount', doc FROM ({_hour_doc(ORDERS, 'create_date', 'create_hour',
                                                                   _money('total_amount'))}) b""",
}

_AGE = ("CASE WHEN user_age IS NULL THEN NULL WHEN user_age < 20 THEN '20岁以下' "
        "WHEN user_age <= 30 THEN '20-30岁' ELSE '30岁以上' END")
_GENDER = "CASE user_gender WHEN 'M' THEN '男' WHEN 'F' THEN '女' END"
_GRID_STRUCT = "{" + ", ".join(f"'{c.strip()}': {c.strip()}" for c in GRID.split(",")) + "}"

ORACLE_SQL["report_detail"] = f"""
WITH s AS (SELECT * FROM ({DETAIL}) d WHERE contains(lower(sku_name), 'ring') AND contains(lower(sku_name), 'red')),
     page AS (SELECT {GRID} FROM s ORDER BY {GRID_ASC} LIMIT {P.PAGE_LENGTH} OFFSET {P.PAGE_START}),
     age AS (SELECT {_AGE} AS name, COUNT(*) AS value FROM s GROUP BY 1),
     gen AS (SELECT {_GENDER} AS name, COUNT(*) AS value FROM s GROUP BY 1)
SELECT to_json({{'draw': {P.DRAW},
                 'data': {{'total': (SELECT COUNT(*) FROM s),
                           'stat': [{{'options': (SELECT list({{'name': name, 'value': value}} ORDER BY name) FROM age)}},
                                    {{'options': (SELECT list({{'name': name, 'value': value}} ORDER BY name) FROM gen)}}],
                           'detail': (SELECT list({_GRID_STRUCT} ORDER BY {GRID_ASC}) FROM page)}}}}) AS doc
"""

# --- stream jobs: the table a stream builds equals the batch answer ---------------------

ORDERS_FLAGGED = f"""
SELECT *, CASE WHEN row_number() OVER (PARTITION BY user_id
                 ORDER BY create_time, TRY_CAST(id AS BIGINT) NULLS FIRST, id) = 1 THEN '1' ELSE '0' END AS is_first_order
FROM ({ORDERS}) o
"""

VIEWED = """SELECT CAST(event_id AS VARCHAR) AS key, CAST(epoch_us(ts) // 1000 AS BIGINT) AS ts FROM events WHERE event_type = 'view'"""

ORACLE_SQL.update({
    "src_topic": f"""WITH v AS ({VIEWED}), b AS (SELECT MIN(ts) AS lo, MAX(ts) AS hi FROM v)
                     SELECT key, ts FROM v, b WHERE ts >= ((lo + (hi - lo) // 2) // 86400000) * 86400000 + 43200000""",
    "src_cdc": """WITH t AS (SELECT CAST(SUM(CASE event_type WHEN 'purchase' THEN 2 WHEN 'click' THEN 1 WHEN 'signup' THEN 1 ELSE 0 END) AS BIGINT) AS n FROM events),
                  m AS (SELECT n, (n + 9) // 10 AS most FROM t)
                  SELECT f.fetch, LEAST(most, n - f.fetch * most) AS messages, LEAST(most, n - f.fetch * most) AS distinct_keys
                  FROM m, (SELECT UNNEST(generate_series(0, 9)) AS fetch) f WHERE n > f.fetch * most""",
    "sink_topic": VIEWED,
    "stream_collect": f"""SELECT CAST(event_id AS VARCHAR) AS key,
                           CASE WHEN event_type = 'view' THEN 'startup_log' ELSE 'event_log' END AS topic,
                           CAST(epoch_us(ts) // 1000 AS BIGINT) AS ts FROM events""",
    "stream_cdc": ORACLE_SQL["cdc_after_image"],
    "stream_dau": DAU,
    "stream_dau_state": DAU,
    "stream_dau_ttl": DAU,
    "stream_new_mid": f"""WITH x AS (SELECT mid, MIN(logDate) AS f FROM ({STARTUP}) s GROUP BY mid)
                           SELECT f AS logDate, COUNT(*) AS new_mid FROM x WHERE f <> '{D}' GROUP BY f
                           UNION ALL
                           SELECT '{D}', COUNT(*) FILTER (WHERE f = '{D}') FROM x""",
    "sink_dau": DAU,
    "paged_detail_deep": f"""SELECT * EXCLUDE (rn) FROM (
        SELECT {GRID}, COUNT(*) OVER () AS total, row_number() OVER (ORDER BY sku_price DESC NULLS LAST, order_id NULLS FIRST, {GRID_ASC}) AS rn FROM ({DETAIL}) s) t
        WHERE rn > total // 2 AND rn <= total // 2 + {P.PAGE_LENGTH}""",
    "seen_union_bits": DAU,
    "hourly_active_kept": f"SELECT logHour, COUNT(DISTINCT mid) AS active, TRUE AS near FROM ({STARTUP}) s WHERE logDate = '{D}' GROUP BY logHour",
    "report_total_kept": ORACLE_SQL["report_total"],
    "report_hour_kept": ORACLE_SQL["report_hour"],
    "stream_orders": ORDERS_FLAGGED,
    "sink_order": ORDERS_FLAGGED,
    "stream_first_order": ORDERS_FLAGGED,
})
