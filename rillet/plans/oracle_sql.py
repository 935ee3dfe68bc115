"""DuckDB oracle SQL for the registered queries.

The CTEs below restate the test-data adapters of ``rillet.sources.adapters`` in
SQL, so each query's oracle is computed independently of the Spark code. Views
for the driver tables (events, orders, ...) are pre-registered by the caller.
"""

from __future__ import annotations

K = "CAST(json_extract_string(e.props, '$.k') AS INTEGER)"

PAGE_LOG = f"""
page_log AS (
  SELECT c.c_nationkey AS province_id,
         'b' || CAST(e.user_id % 4 AS VARCHAR) AS brand,
         'ch' || CAST({K} % 5 AS VARCHAR) AS channel,
         CASE WHEN e.user_id % 2 = 0 THEN '1' ELSE '0' END AS is_new,
         'm' || CAST(e.user_id % 7 AS VARCHAR) AS model,
         CAST(e.user_id AS VARCHAR) AS mid,
         CASE WHEN e.user_id % 3 = 0 THEN 'ios' ELSE 'android' END AS operate_system,
         CAST(e.user_id AS VARCHAR) AS user_id,
         'v' || CAST(e.user_id % 3 AS VARCHAR) AS version_code,
         CAST(round(e.value * 1000) AS BIGINT) AS during_time,
         CAST({K} AS VARCHAR) AS page_item,
         'sku_id' AS page_item_type,
         lag(e.event_type) OVER (PARTITION BY e.user_id, CAST(e.ts AS DATE)
                                 ORDER BY e.ts, e.event_id) AS last_page_id,
         e.event_type AS page_id,
         CASE WHEN {K} % 2 = 0 THEN 'promotion' ELSE 'query' END AS sourceType,
         epoch_us(e.ts) // 1000 AS ts,
         e.event_id AS seq
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey)"""

DAU = """
dau AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY dt, mid ORDER BY ts, seq) AS rn
    FROM (SELECT *, strftime(epoch_ms(ts), '%Y-%m-%d') AS dt,
                    strftime(epoch_ms(ts), '%H') AS hr
          FROM page_log WHERE last_page_id IS NULL))
  WHERE rn = 1)"""

AS_OF = "DATE '2024-01-31'"

USER_INFO = f"""
user_info AS (
  SELECT c_custkey AS id,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         DATE '1950-01-01' + CAST(c_custkey * 37 % 18000 AS INTEGER) AS birthday
  FROM customer),
user_dim AS (
  SELECT id, gender AS user_gender,
         CAST(year({AS_OF}) - year(birthday)
              - CASE WHEN strftime({AS_OF}, '%m%d') < strftime(birthday, '%m%d') THEN 1 ELSE 0 END
              AS INTEGER) AS user_age
  FROM user_info)"""

PROVINCE = """
base_province AS (
  SELECT n_nationkey AS id, n_name AS name, CAST(n_regionkey AS VARCHAR) AS area_code,
         CAST(n_nationkey AS VARCHAR) AS iso_code,
         'CN-' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS iso_3166_2
  FROM nation)"""

CREATE_TIME = "strftime(o.o_orderdate + to_seconds(o.o_orderkey % 80000), '%Y-%m-%d %H:%M:%S')"

ORDER_INFO = f"""
order_info AS (
  SELECT o.o_orderkey AS id, c.c_nationkey AS province_id, o.o_orderstatus AS order_status,
         o.o_custkey AS user_id, CAST(o.o_totalprice AS DECIMAL(18,2)) AS total_amount,
         {CREATE_TIME} AS create_time
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
order_enriched AS (
  SELECT oi.*, split_part(oi.create_time, ' ', 1) AS create_date,
         split_part(split_part(oi.create_time, ' ', 2), ':', 1) AS create_hour,
         p.name AS province_name, p.area_code AS province_area_code,
         p.iso_code AS province_iso_code, p.iso_3166_2 AS province_iso_3166_2,
         u.user_gender, u.user_age
  FROM order_info oi LEFT JOIN user_dim u ON oi.user_id = u.id
  LEFT JOIN base_province p ON oi.province_id = p.id)"""

ORDER_DETAIL = f"""
order_detail AS (
  SELECT l.l_orderkey * 1000 + row_number() OVER (
           PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey,
           l.l_shipdate, l.l_extendedprice, l.l_quantity, l.l_discount, l.l_tax,
           l.l_returnflag, l.l_linestatus) AS id,
         l.l_orderkey AS order_id, l.l_partkey AS sku_id,
         CAST(p.p_retailprice AS DECIMAL(18,2)) AS order_price,
         CAST(l.l_quantity AS BIGINT) AS sku_num, p.p_name AS sku_name,
         strftime(o.o_orderdate + to_seconds(o.o_orderkey % 80000 + 60 * row_number() OVER (
           PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey,
           l.l_shipdate, l.l_extendedprice, l.l_quantity, l.l_discount, l.l_tax,
           l.l_returnflag, l.l_linestatus)), '%Y-%m-%d %H:%M:%S') AS create_time,
         CAST(round(CAST(l.l_extendedprice AS DECIMAL(18,2))
                    * (1 - CAST(l.l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(18,2))
           AS split_total_amount
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey)"""

ORDER_WIDE = """
order_wide AS (
  SELECT d.id AS detail_id, o.id AS order_id, d.sku_id, d.order_price, d.sku_num, d.sku_name,
         d.split_total_amount, d.create_time, o.province_id, o.order_status, o.user_id,
         o.total_amount, o.create_date, o.create_hour, o.province_name,
         o.province_area_code, o.province_iso_code, o.province_iso_3166_2,
         o.user_gender, o.user_age
  FROM order_detail d JOIN order_enriched o ON d.order_id = o.id)"""

WIDE_CTES = ",".join([USER_INFO, PROVINCE, ORDER_INFO, ORDER_DETAIL, ORDER_WIDE])

TOKENS = "regexp_extract_all(lower({x}), '[a-z0-9]+')"


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


SQL: dict[str, str] = {}

SQL["dau_realtime_hours"] = with_(PAGE_LOG, DAU, """
counts AS (SELECT dt, hr, count(*) AS n FROM dau GROUP BY dt, hr),
grid AS (SELECT d.dt, lpad(CAST(h.h AS VARCHAR), 2, '0') AS hr
         FROM (SELECT DISTINCT dt FROM counts) d, range(0, 24) h(h)),
tot AS (SELECT dt, CAST(sum(n) AS BIGINT) AS total FROM counts GROUP BY dt)""") + """
SELECT g.dt, g.hr, CAST(coalesce(td.n, 0) AS BIGINT) AS dau_td,
       CAST(coalesce(yd.n, 0) AS BIGINT) AS dau_yd,
       CAST(coalesce(tot.total, 0) AS BIGINT) AS dau_total
FROM grid g
LEFT JOIN counts td ON td.dt = g.dt AND td.hr = g.hr
LEFT JOIN counts yd ON strftime(CAST(yd.dt AS DATE) + 1, '%Y-%m-%d') = g.dt AND yd.hr = g.hr
LEFT JOIN tot ON tot.dt = g.dt"""

SQL["dau_wide"] = with_(PAGE_LOG, DAU, USER_INFO, PROVINCE) + """
SELECT d.province_id, d.brand, d.channel, d.is_new, d.model, d.mid, d.operate_system,
       d.user_id, d.version_code, d.during_time, d.page_item, d.page_item_type, d.page_id,
       u.user_gender, u.user_age, p.name AS province_name, p.iso_code AS province_iso_code,
       p.iso_3166_2 AS province_iso_3166_2, p.area_code AS province_area_code,
       d.dt, d.hr, d.ts
FROM dau d LEFT JOIN user_dim u ON CAST(d.user_id AS BIGINT) = u.id
LEFT JOIN base_province p ON d.province_id = p.id"""

SQL["stage_counts"] = with_(PAGE_LOG, DAU) + """
SELECT 'parsed' AS stage, count(*) AS rows FROM page_log
UNION ALL SELECT 'entry_filter', count(*) FROM page_log WHERE last_page_id IS NULL
UNION ALL SELECT 'dedup', count(*) FROM dau"""

SQL["dau_total_day"] = with_(PAGE_LOG, DAU) + """
SELECT dt, count(*) AS dau_total FROM dau WHERE dt = (
  SELECT strftime(max(ts), '%Y-%m-%d') FROM events) GROUP BY dt"""

SQL["dau_count_by_hour"] = with_(PAGE_LOG, DAU) + """
SELECT dt, hr, count(*) AS n FROM dau GROUP BY dt, hr"""

SQL["dau_hours_empty_today"] = with_(PAGE_LOG, DAU, """
newest AS (SELECT max(CAST(ts AS DATE)) AS d FROM events)""") + """
SELECT strftime(newest.d + 1, '%Y-%m-%d') AS dt, lpad(CAST(h.h AS VARCHAR), 2, '0') AS hr,
       CAST(0 AS BIGINT) AS dau_td,
       (SELECT count(*) FROM dau WHERE dau.dt = strftime(newest.d, '%Y-%m-%d')
          AND CAST(dau.hr AS INTEGER) = h.h) AS dau_yd, CAST(0 AS BIGINT) AS dau_total
FROM newest, range(0, 24) h(h)"""

SQL["column_scan"] = with_(PAGE_LOG, DAU) + "SELECT dt, mid FROM dau"


# ---- order wide table and read side ---------------------------------------

def _tok(x: str) -> str:
    return TOKENS.format(x=x)


def _list(terms) -> str:
    return "[" + ", ".join(f"'{t}'" for t in terms) + "]"


def bm25_sql(terms: list[str], source: str, text: str) -> str:
    """CTEs docs/st/scored: BM25 (k1=1.2, b=0.75) of ``text`` over ``source``."""
    tfs = ", ".join(f"len(list_filter(toks, lambda x: x = '{t}')) AS tf{i}" for i, t in enumerate(terms))
    dfs = ", ".join(f"count(*) FILTER (WHERE list_contains(toks, '{t}')) AS df{i}"
                    for i, t in enumerate(terms))
    parts = " + ".join(
        f"ln(1 + (st.n - st.df{i} + 0.5) / (st.df{i} + 0.5)) * tf{i} * 2.2"
        f" / (tf{i} + 1.2 * (0.25 + 0.75 * len(toks) / st.avgdl))" for i in range(len(terms)))
    return f"""
docs AS (SELECT *, {_tok(text)} AS toks FROM {source}),
st AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl, {dfs} FROM docs),
scored AS (SELECT d.*, ({parts}) AS score FROM (SELECT *, {tfs} FROM docs) d, st)"""


def _hl(text: str, terms: list[str], pre: str = "<em>", post: str = "</em>") -> str:
    alt = "|".join(sorted(terms, key=lambda s: (-len(s), s)))
    pre_s, post_s = pre.replace("'", "''"), post.replace("'", "''")
    return f"regexp_replace({text}, '\\b({alt})\\b', '{pre_s}\\1{post_s}', 'gi')"


WIDE = with_(WIDE_CTES)
W_TOKS = _tok("sku_name")

SQL["order_wide"] = WIDE + """
SELECT detail_id, order_id, sku_id, CAST(order_price AS DOUBLE) AS order_price, sku_num, sku_name,
       CAST(split_total_amount AS DOUBLE) AS split_total_amount,
       CAST(0 AS DOUBLE) AS split_activity_amount, CAST(0 AS DOUBLE) AS split_coupon_amount,
       create_time, province_id, order_status, user_id, CAST(total_amount AS DOUBLE) AS total_amount,
       CAST(0 AS DOUBLE) AS activity_reduce_amount, CAST(0 AS DOUBLE) AS coupon_reduce_amount,
       CAST(total_amount AS DOUBLE) AS original_total_amount,
       CAST(0 AS DOUBLE) AS feight_fee, CAST(0 AS DOUBLE) AS feight_fee_reduce,
       CAST(NULL AS VARCHAR) AS operate_time, CAST(NULL AS VARCHAR) AS expire_time,
       CAST(NULL AS VARCHAR) AS refundable_time, create_date, create_hour,
       province_name, province_area_code, province_iso_code, province_iso_3166_2,
       user_gender, user_age
FROM order_wide"""

SQL["order_defaults"] = with_(ORDER_INFO.split("order_enriched AS")[0].rstrip().rstrip(",")) + """
SELECT id, user_id, create_time,
       CAST(CASE WHEN id % 5 <> 0 THEN total_amount ELSE 0 END AS DOUBLE) AS total_amount,
       CAST(CASE WHEN id % 3 <> 0 THEN total_amount ELSE 0 END AS DOUBLE) AS original_total_amount,
       CAST(0 AS DOUBLE) AS activity_reduce_amount, CAST(0 AS DOUBLE) AS coupon_reduce_amount,
       CAST(0 AS DOUBLE) AS feight_fee, CAST(0 AS DOUBLE) AS feight_fee_reduce
FROM order_info"""

SQL["order_full_outer"] = with_(ORDER_INFO.split("order_enriched AS")[0].rstrip().rstrip(","),
                                ORDER_DETAIL) + """
SELECT coalesce(o.id, d.order_id) AS order_id, d.id AS detail_id,
       o.id IS NOT NULL AS has_order, d.id IS NOT NULL AS has_detail
FROM order_info o FULL OUTER JOIN order_detail d ON o.id = d.order_id"""

_MATCHED = """
m AS (SELECT * FROM order_wide WHERE list_has_all({toks}, ['widget']){day})"""
_NEWEST = " AND create_date = (SELECT max(create_date) FROM order_enriched)"

_GENDER = """
SELECT CASE WHEN user_gender = 'M' THEN '男' ELSE '女' END AS name,
       CAST(sum(split_total_amount) AS DOUBLE) AS value
FROM m WHERE user_gender IS NOT NULL GROUP BY user_gender"""

_AGE = "".join(f"""{union}
SELECT '{name}' AS name, CAST(coalesce(sum(split_total_amount) FILTER (WHERE {cond}), 0) AS DOUBLE) AS value
FROM m""" for union, name, cond in (
    ("", "30岁以下", "user_age < 30"), ("\nUNION ALL", "30-50岁", "user_age BETWEEN 30 AND 50"),
    ("\nUNION ALL", "50岁以上", "user_age > 50")))

for _day, _tail in (("", ""), (_NEWEST, "_day")):
    SQL[f"stats_by_gender{_tail}"] = with_(WIDE_CTES, _MATCHED.format(toks=W_TOKS, day=_day)) + _GENDER
    SQL[f"stats_by_age_band{_tail}"] = with_(WIDE_CTES, _MATCHED.format(toks=W_TOKS, day=_day)) + _AGE

SQL["stats_unknown_type"] = with_(WIDE_CTES, _MATCHED.format(toks=W_TOKS, day="")) + """
SELECT 'gender' AS type, count(DISTINCT user_gender) AS rows
FROM m WHERE user_gender IS NOT NULL
UNION ALL SELECT 'age', 3 UNION ALL SELECT 'region', 0"""

_RW = ["red", "widget"]

SQL["detail_by_item"] = with_(WIDE_CTES, bm25_sql(_RW, "order_wide", "sku_name")) + f"""
SELECT detail_id, {_hl('sku_name', _RW)} AS sku_name, sku_num, province_name,
       CAST(order_price AS DOUBLE) AS order_price, CAST(total_amount AS DOUBLE) AS total_amount,
       user_age, user_gender, create_time
FROM scored WHERE list_has_all(toks, {_list(_RW)})
ORDER BY score DESC, detail_id LIMIT 20 OFFSET 0"""

SQL["detail_by_item_day"] = with_(
    WIDE_CTES, "d1 AS (SELECT * FROM order_wide WHERE true" + _NEWEST + ")",
    bm25_sql(["widget"], "d1", "sku_name")) + f"""
SELECT detail_id, {_hl('sku_name', ['widget'])} AS sku_name, sku_num, province_name,
       CAST(order_price AS DOUBLE) AS order_price, CAST(total_amount AS DOUBLE) AS total_amount,
       user_age, user_gender, create_time
FROM scored WHERE list_has_all(toks, ['widget'])
ORDER BY score DESC, detail_id LIMIT 20 OFFSET 0"""

SQL["detail_total"] = WIDE + f"""
SELECT count(*) AS total FROM order_wide WHERE list_has_all({W_TOKS}, {_list(_RW)})"""

SQL["missing_day"] = WIDE + f"""
SELECT count(*) AS total FROM order_wide
WHERE create_date = '1900-01-01' AND list_has_all({W_TOKS}, {_list(_RW)})"""

SQL["term_filter"] = WIDE + "SELECT detail_id, user_age FROM order_wide WHERE user_age = 30"

SQL["range_filter"] = WIDE + """
SELECT detail_id, CAST(split_total_amount AS DOUBLE) AS split_total_amount
FROM order_wide WHERE split_total_amount BETWEEN 1000 AND 2000"""

SQL["bool_filter"] = WIDE + f"""
SELECT detail_id, sku_name, user_gender, order_status FROM order_wide
WHERE list_has_all({W_TOKS}, ['widget']) AND coalesce(user_gender = 'M', false)
  AND NOT coalesce(order_status = 'F', false)"""

SQL["exclude_fields"] = WIDE + """
SELECT detail_id, order_id, sku_name, user_gender, province_name FROM order_wide"""

SQL["sort_page"] = WIDE + """
SELECT detail_id, CAST(split_total_amount AS DOUBLE) AS split_total_amount FROM order_wide
ORDER BY split_total_amount DESC, detail_id LIMIT 10 OFFSET 20"""

SQL["point_get"] = WIDE + """
SELECT detail_id, order_id, sku_name, CAST(split_total_amount AS DOUBLE) AS split_total_amount
FROM order_wide WHERE detail_id = 1001"""

SQL["read_all"] = WIDE + "SELECT detail_id, order_id, sku_id, create_time FROM order_wide"

SQL["max_agg"] = WIDE + "SELECT max(user_age) AS max_age FROM order_wide"

SQL["group_count_top10"] = WIDE + """
SELECT user_age, count(*) AS doc_count FROM order_wide WHERE user_age IS NOT NULL
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""

SQL["nested_avg_topk"] = with_(WIDE_CTES, """
pb AS (SELECT DISTINCT w.order_id, p.p_brand AS brand FROM order_wide w
       LEFT JOIN part p ON w.sku_id = p.p_partkey WHERE p.p_brand IS NOT NULL),
ot AS (SELECT DISTINCT order_id, total_amount FROM order_wide)""") + """
SELECT brand, count(*) AS doc_count, round(CAST(avg(ot.total_amount) AS DOUBLE), 6) AS avg_amount
FROM pb JOIN ot USING (order_id) GROUP BY brand
ORDER BY avg(ot.total_amount) DESC, brand LIMIT 10"""

SQL["match_any"] = WIDE + f"""
SELECT detail_id, {_hl('sku_name', _RW, "<font color='red'>", "</font>")} AS sku_name
FROM order_wide WHERE list_has_any({W_TOKS}, {_list(_RW)})"""

SQL["fuzzy_match"] = WIDE + f"""
SELECT detail_id, sku_name FROM order_wide
WHERE len(list_filter({W_TOKS}, lambda x: levenshtein(x, 'widgit') <= 2)) > 0"""

SQL["fuzzy_transpose"] = WIDE + f"""
SELECT detail_id, sku_name FROM order_wide
WHERE len(list_filter({W_TOKS}, lambda x: damerau_levenshtein(x, 'wdiget') <= 1)) > 0"""

SQL["highlight_han"] = WIDE + """
SELECT detail_id, regexp_replace('天天行动 ' || sku_name, '(行|动|\\bwidget\\b)', '<em>\\1</em>', 'gi') AS sku_name
FROM order_wide"""

SQL["bm25_rank"] = with_(WIDE_CTES, bm25_sql(_RW, "order_wide", "sku_name")) + f"""
SELECT detail_id, sku_name, round(score, 6) AS score FROM scored
WHERE list_has_any(toks, {_list(_RW)}) ORDER BY score DESC, detail_id LIMIT 100"""

# ---- log routes --------------------------------------------------------------

LOG_ROWS = """
lg AS (SELECT *, CAST(page_item AS INTEGER) AS k FROM page_log)"""

_DEV = """CAST(province_id AS VARCHAR) AS province_id, channel, is_new, model, mid,
       operate_system, user_id, version_code"""
_PG = "page_id, last_page_id, page_item, page_item_type, during_time"

SQL["log_error_route"] = with_(PAGE_LOG, LOG_ROWS) + """
SELECT '{"error_code":' || CAST(k AS VARCHAR) || ',"msg":"boom"}' AS err FROM lg
WHERE page_id = 'error'"""

SQL["log_page_route"] = with_(PAGE_LOG, LOG_ROWS) + f"""
SELECT {_DEV}, brand, during_time, page_item, page_item_type, last_page_id, page_id,
       sourceType, ts
FROM lg WHERE page_id <> 'error'"""

SQL["log_action_explode"] = with_(PAGE_LOG, LOG_ROWS) + f"""
SELECT {_DEV}, {_PG}, 'act' || CAST(i AS VARCHAR) AS action_id, page_item AS action_item,
       'sku_id' AS action_item_type, ts + (i + 1) * 1000 AS action_ts, ts
FROM (SELECT *, unnest(range(k % 3)) AS i FROM lg WHERE page_id <> 'error')"""

_DISP = """'promotion' AS displayType, CAST(k + i AS VARCHAR) AS display_item,
       'sku_id' AS display_item_type, CAST(i + 1 AS VARCHAR) AS "order",
       CAST(i % 3 + 1 AS VARCHAR) AS pos_id, ts"""

SQL["log_display_explode"] = with_(PAGE_LOG, LOG_ROWS) + f"""
SELECT {_DEV}, {_PG}, {_DISP}
FROM (SELECT *, unnest(range(k % 4)) AS i FROM lg WHERE page_id <> 'error')"""

SQL["log_display_compat"] = with_(PAGE_LOG, LOG_ROWS) + f"""
SELECT {_DEV}, {_PG}, {_DISP}
FROM (SELECT *, unnest(range(k % 4)) AS i
      FROM (SELECT *, unnest(range(k % 3)) AS a FROM lg WHERE page_id <> 'error'))"""

SQL["log_start_route"] = with_(PAGE_LOG, LOG_ROWS) + f"""
SELECT {_DEV}, 'icon' AS entry, during_time AS loading_time, CAST(k AS VARCHAR) AS open_ad_id,
       CAST(k * 10 AS BIGINT) AS open_ad_ms, CAST(0 AS BIGINT) AS open_ad_skip_ms, ts
FROM lg WHERE page_id = 'signup'"""

SQL["log_route_counts"] = with_(PAGE_LOG, LOG_ROWS) + """
SELECT 'error' AS route, count(*) FILTER (WHERE page_id = 'error') AS rows FROM lg
UNION ALL SELECT 'page', count(*) FILTER (WHERE page_id <> 'error') FROM lg
UNION ALL SELECT 'action', CAST(sum(CASE WHEN page_id <> 'error' THEN k % 3 ELSE 0 END) AS BIGINT) FROM lg
UNION ALL SELECT 'display', CAST(sum(CASE WHEN page_id <> 'error' THEN k % 4 ELSE 0 END) AS BIGINT) FROM lg
UNION ALL SELECT 'display_compat',
  CAST(sum(CASE WHEN page_id <> 'error' THEN (k % 3) * (k % 4) ELSE 0 END) AS BIGINT) FROM lg
UNION ALL SELECT 'start', count(*) FILTER (WHERE page_id = 'signup') FROM lg"""

# ---- change records ----------------------------------------------------------

CDC = """
cdc AS (
  SELECT CASE o_custkey % 3 WHEN 0 THEN 'order_info' WHEN 1 THEN 'user_info'
              ELSE 'base_province' END AS "table",
         CASE o_orderkey % 6 WHEN 0 THEN 'bootstrap-start' WHEN 1 THEN 'bootstrap-insert'
              WHEN 2 THEN 'insert' WHEN 3 THEN 'update' WHEN 4 THEN 'delete'
              ELSE 'bootstrap-complete' END AS type,
         o_orderkey AS seq, o_custkey, o_orderstatus AS status, o_totalprice AS amount
  FROM orders),
ops AS (
  SELECT *, CASE "table" WHEN 'order_info' THEN CAST(seq AS VARCHAR)
                 WHEN 'user_info' THEN 'u-' || o_custkey
                 ELSE CAST(o_custkey % 25 AS VARCHAR) END AS id
  FROM (SELECT *, CASE type WHEN 'bootstrap-insert' THEN 'I' WHEN 'insert' THEN 'I'
                            WHEN 'update' THEN 'U' WHEN 'delete' THEN 'D' END AS op FROM cdc)
  WHERE op IS NOT NULL)"""

SQL["cdc_op_map"] = with_(CDC) + 'SELECT seq, "table", type, op, id FROM ops'

SQL["cdc_fact_route"] = with_(CDC) + """
SELECT 'DWD_' || upper("table") || '_' || op AS topic, CAST(id AS VARCHAR) AS key, seq,
       id || '/' || status AS value
FROM ops WHERE "table" IN ('order_info', 'user_info')"""

SQL["cdc_dim_latest"] = with_(CDC) + """
SELECT 'DIM:' || upper("table") || ':' || CAST(id AS VARCHAR) AS dim_key, "table", id, op, seq,
       status, round(amount, 2) AS amount
FROM (SELECT *, row_number() OVER (PARTITION BY "table", id ORDER BY seq DESC) AS rn
      FROM ops WHERE "table" IN ('user_info', 'base_province'))
WHERE rn = 1 AND op <> 'D'"""

# ---- documents, roll-up, partitioner, scalars ----------------------------------

USER_DOCS = """
user_docs AS (
  SELECT c.c_custkey AS id, c.c_name AS name, CAST(2024 - year(u.birthday) AS INTEGER) AS age,
         CASE WHEN u.gender = 'M' THEN '男' ELSE '女' END AS sex, CAST(0 AS BIGINT) AS seq
  FROM customer c LEFT JOIN user_info u ON c.c_custkey = u.id),
user_changes AS (
  SELECT o_custkey AS id, 'order_' || CAST(o_orderkey AS VARCHAR) AS name,
         CAST(o_orderkey % 80 AS INTEGER) AS age,
         CASE WHEN o_orderstatus = 'F' THEN '女' ELSE '男' END AS sex, o_orderkey AS seq
  FROM orders),
latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM user_changes)
  WHERE rn = 1)"""

SQL["upsert_last_wins"] = with_(USER_INFO, USER_DOCS) + """
SELECT * FROM user_docs WHERE id NOT IN (SELECT id FROM latest)
UNION ALL SELECT id, name, age, sex, seq FROM latest"""

SQL["partial_update"] = with_(USER_INFO, USER_DOCS) + """
SELECT d.id, d.name, d.age, CASE WHEN l.id IS NOT NULL THEN l.sex ELSE d.sex END AS sex, d.seq
FROM user_docs d LEFT JOIN latest l ON d.id = l.id"""

SQL["update_by_query"] = with_(WIDE_CTES, """
items AS (SELECT w.order_id, w.order_status, w.sku_id AS id, p.p_brand AS name
          FROM order_wide w LEFT JOIN part p ON w.sku_id = p.p_partkey)""") + """
SELECT order_id, any_value(order_status) AS order_status, CAST(count(*) AS INTEGER) AS n_items,
       min(id) AS first_id,
       CASE WHEN any_value(order_status) = 'O' THEN 'renamed' ELSE arg_min(name, id) END
         AS first_name
FROM items GROUP BY order_id"""

SQL["delete_by_id"] = with_(USER_INFO, USER_DOCS) + "SELECT * FROM user_docs WHERE id <> 1"

SQL["bulk_delete"] = with_(USER_INFO, USER_DOCS, CDC) + """
SELECT * FROM user_docs
WHERE id NOT IN (SELECT o_custkey FROM ops WHERE "table" = 'user_info' AND op = 'D')"""

SQL["stored_delete"] = with_(USER_INFO, USER_DOCS) + """
SELECT id, name, age, seq FROM (
  SELECT * FROM user_docs WHERE id NOT IN (SELECT id FROM latest)
  UNION ALL SELECT id, name, age, sex, seq FROM latest)
WHERE age <= 60 AND id // 50 <> 1"""

SQL["append_new"] = with_(USER_INFO, USER_DOCS) + """
SELECT CAST(id AS VARCHAR) AS id, name, seq FROM user_docs
UNION ALL
SELECT md5('{"name":"' || name || '","seq":' || CAST(seq AS VARCHAR) || '}') AS id, name, seq
FROM (SELECT 'pending_' || CAST(o_orderkey AS VARCHAR) AS name, o_orderkey AS seq
      FROM orders WHERE o_orderstatus = 'P')"""

SQL["event_rollup"] = """
WITH e AS (SELECT event_id, CASE WHEN event_id % 17 <> 0 THEN user_id END AS user_id,
                  CASE WHEN event_id % 7 <> 0 THEN event_type END AS event_type, value,
                  epoch_us(ts) // 1000 AS ts FROM events),
c AS (SELECT *, CASE WHEN row_number() OVER w = 1
                       OR lag(event_type) OVER w IS DISTINCT FROM event_type THEN 1 ELSE 0 END AS chg
      FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(chg) OVER (PARTITION BY user_id ORDER BY ts, event_id
                               ROWS UNBOUNDED PRECEDING) AS run_no FROM c)
SELECT user_id, event_type, min(ts) AS start_time, max(ts) AS end_time,
       arg_min(value, (ts, event_id)) AS start_value, arg_max(value, (ts, event_id)) AS end_value,
       min(value) AS min_value, max(value) AS max_value, count(*) AS n_rows
FROM r GROUP BY user_id, event_type, run_no"""

SQL["append_ids_unique"] = """
SELECT how, n AS rows, n AS ids
FROM (SELECT count(*) AS n FROM orders), (VALUES ('content'), ('random')) h(how)"""

SQL["json_members"] = with_(PAGE_LOG) + """
SELECT seq, mid, during_time, CAST(CAST(page_item AS INTEGER) % 3 AS INTEGER) AS n_actions,
       CAST(CAST(page_item AS INTEGER) % 4 AS INTEGER) AS n_displays
FROM page_log"""

SQL["route_partition_ids"] = """
SELECT event_type AS key,
       CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 ELSE 3 END
         AS partition_id,
       count(*) AS n
FROM events GROUP BY 1, 2"""

SQL["scalar_map_json"] = """
SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type"""

# ---- streaming replays (final sink content) -----------------------------------

SQL["stream_dau_dedup"] = with_(PAGE_LOG, DAU, USER_INFO, PROVINCE) + """
SELECT d.dt, d.mid, u.user_gender, u.user_age, p.name AS province_name
FROM dau d LEFT JOIN user_dim u ON CAST(d.user_id AS BIGINT) = u.id
LEFT JOIN base_province p ON d.province_id = p.id"""

SQL["stream_restart"] = with_(PAGE_LOG, DAU) + "SELECT dt, count(*) AS n FROM dau GROUP BY dt"

SQL["state_rebuild"] = with_(PAGE_LOG, DAU) + """
SELECT dt, mid, CAST(1 AS BIGINT) AS copies FROM dau"""

SQL["stream_order_join"] = WIDE + """
SELECT detail_id, order_id, create_date, user_gender, province_name,
       CAST(split_total_amount AS DOUBLE) AS split_total_amount
FROM order_wide"""

SQL["log_route_contents"] = with_(PAGE_LOG, LOG_ROWS) + """
SELECT 'error' AS route, CAST(NULL AS VARCHAR) AS mid, CAST(NULL AS BIGINT) AS ts, CAST(k AS VARCHAR) AS detail
FROM lg WHERE page_id = 'error'
UNION ALL SELECT 'page', mid, ts, page_id FROM lg WHERE page_id <> 'error'
UNION ALL SELECT 'action', mid, ts + (i + 1) * 1000, 'act' || i
  FROM (SELECT *, unnest(range(k % 3)) AS i FROM lg WHERE page_id <> 'error')
UNION ALL SELECT 'display', mid, ts, CAST(k + i AS VARCHAR)
  FROM (SELECT *, unnest(range(k % 4)) AS i FROM lg WHERE page_id <> 'error')
UNION ALL SELECT 'start', mid, ts, CAST(k AS VARCHAR) FROM lg WHERE page_id = 'signup'"""

SQL["stream_log_routes"] = with_(PAGE_LOG, LOG_ROWS) + """
SELECT 'error' AS route, count(*) FILTER (WHERE page_id = 'error') AS rows FROM lg
UNION ALL SELECT 'page', count(*) FILTER (WHERE page_id <> 'error') FROM lg
UNION ALL SELECT 'action', CAST(sum(CASE WHEN page_id <> 'error' THEN k % 3 ELSE 0 END) AS BIGINT) FROM lg
UNION ALL SELECT 'display', CAST(sum(CASE WHEN page_id <> 'error' THEN k % 4 ELSE 0 END) AS BIGINT) FROM lg
UNION ALL SELECT 'start', count(*) FILTER (WHERE page_id = 'signup') FROM lg"""

SQL["stream_fact_topics"] = with_(CDC) + """
SELECT 'DWD_' || upper("table") || '_' || op AS topic, id AS key, seq, id || '/' || status AS value,
       row_number() OVER (PARTITION BY "table", op, id ORDER BY seq) AS turn
FROM ops WHERE "table" IN ('order_info', 'user_info')"""

SQL["stream_cdc_config_change"] = with_(CDC, """
cut AS (SELECT min(o_orderkey) + (max(o_orderkey) - min(o_orderkey)) * 0.5 AS half FROM orders)""") + """
SELECT 'DWD_' || upper("table") || '_' || op AS topic, count(*) AS rows
FROM ops, cut WHERE ("table" IN ('order_info', 'user_info') AND seq < half)
   OR ("table" IN ('order_info', 'base_province') AND seq >= half)
GROUP BY 1"""

SQL["stream_chain"] = with_(PAGE_LOG, USER_INFO, PROVINCE, """
d AS (SELECT DISTINCT strftime(epoch_ms(ts), '%Y-%m-%d') AS dt, mid, user_id, brand, province_id
      FROM page_log WHERE last_page_id IS NULL AND page_id <> 'error')""") + """
SELECT d.dt, d.mid, d.brand, u.user_gender, u.user_age, p.name AS province_name
FROM d LEFT JOIN user_dim u ON CAST(d.user_id AS BIGINT) = u.id
LEFT JOIN base_province p ON d.province_id = p.id"""

SQL["stream_late_dropped"] = with_(PAGE_LOG, """
newest AS (SELECT max(CAST(ts AS DATE)) AS d FROM events)""") + """
SELECT count(*) AS dropped FROM page_log, newest
WHERE last_page_id IS NULL AND CAST(epoch_ms(ts) AS DATE) < newest.d - 1"""

SQL["stream_cdc_dims"] = with_(CDC) + """
SELECT 'DIM:' || upper("table") || ':' || CAST(id AS VARCHAR) AS dim_key, "table", id, op, seq
FROM (SELECT *, row_number() OVER (PARTITION BY "table", id ORDER BY seq DESC) AS rn
      FROM ops WHERE "table" IN ('user_info', 'base_province'))
WHERE rn = 1 AND op <> 'D'"""

# ---- dashboard (Q1-Q15) ---------------------------------------------------------

PAGES = """
pages AS (SELECT *, strftime(epoch_ms(ts), '%Y-%m-%d') AS dt FROM page_log)"""

SESSIONS = """
s1 AS (SELECT *, sum(CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END)
                 OVER (PARTITION BY mid, dt ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS session_no
       FROM pages),
sess AS (SELECT mid, dt, session_no, count(*) AS pages, sum(during_time) AS duration_ms,
                arg_min(channel, ts) AS channel, arg_min(is_new, ts) AS is_new
         FROM s1 GROUP BY mid, dt, session_no)"""


def _pct_sql(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) * CAST(100.0 AS DOUBLE) / CAST({whole} AS DOUBLE)"


SQL["q01_pv"] = with_(PAGE_LOG, PAGES) + "SELECT dt, count(*) AS pv FROM pages GROUP BY dt"

SQL["q02_uv"] = with_(PAGE_LOG, PAGES) + "SELECT dt, count(DISTINCT mid) AS uv FROM pages GROUP BY dt"

SQL["q03_visit_total"] = with_(PAGE_LOG, PAGES) + """
SELECT count(*) AS pv_count, count(DISTINCT mid) AS uv_count,
       count(DISTINCT CASE WHEN is_new = '1' THEN mid END) AS new_count FROM pages"""

SQL["q04_new_visit_stats"] = with_(PAGE_LOG, PAGES, SESSIONS, f"""
by_new AS (
  SELECT is_new, CAST(sum(pages) AS DOUBLE) AS page_views,
         CAST(count(DISTINCT mid) AS DOUBLE) AS visitors,
         {_pct_sql("count(*) FILTER (WHERE pages = 1)", "count(*)")} AS bounce_rate,
         avg(duration_ms) / CAST(1000.0 AS DOUBLE) AS avg_duration_s,
         CAST(sum(pages) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_pages
  FROM sess GROUP BY is_new),
longf AS (
  SELECT is_new, 'page_views' AS field, page_views AS v FROM by_new
  UNION ALL SELECT is_new, 'visitors', visitors FROM by_new
  UNION ALL SELECT is_new, 'bounce_rate', bounce_rate FROM by_new
  UNION ALL SELECT is_new, 'avg_duration_s', avg_duration_s FROM by_new
  UNION ALL SELECT is_new, 'avg_pages', avg_pages FROM by_new)""") + """
SELECT field, max(CASE WHEN is_new = '0' THEN v END) AS old,
       max(CASE WHEN is_new = '1' THEN v END) AS new
FROM longf GROUP BY field"""

SQL["q05_channel_pv"] = with_(PAGE_LOG, PAGES) + """
SELECT channel, count(*) AS pv FROM pages GROUP BY channel"""

SQL["q06_channel_bounce"] = with_(PAGE_LOG, PAGES, SESSIONS) + f"""
SELECT channel, count(*) AS sessions, count(*) FILTER (WHERE pages = 1) AS bounces,
       {_pct_sql("count(*) FILTER (WHERE pages = 1)", "count(*)")} AS bounce_rate
FROM sess GROUP BY channel"""

SQL["q07_page_nodes"] = with_(PAGE_LOG, PAGES) + """
SELECT DISTINCT unnest([last_page_id, page_id]) AS name FROM pages WHERE last_page_id IS NOT NULL"""

SQL["q07_page_path"] = with_(PAGE_LOG, PAGES) + """
SELECT last_page_id AS source, page_id AS target, count(*) AS value
FROM pages WHERE last_page_id IS NOT NULL GROUP BY 1, 2"""

_ORD = "o AS (SELECT o_orderkey AS id, o_custkey AS user_id, o_orderstatus AS order_status, CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount FROM orders)"

SQL["q08_user_action_convert"] = with_(PAGE_LOG, PAGES, _ORD, """
c AS (SELECT count(DISTINCT CASE WHEN page_id = 'view' THEN mid END) AS s0,
             count(DISTINCT CASE WHEN page_id = 'click' THEN mid END) AS s1,
             count(DISTINCT CASE WHEN page_id = 'purchase' THEN mid END) AS s2 FROM pages),
oc AS (SELECT count(DISTINCT user_id) AS s3,
              count(DISTINCT CASE WHEN order_status = 'F' THEN user_id END) AS s4 FROM o),
steps AS (
  SELECT 1 AS step_no, '首页' AS step, s0 AS users FROM c
  UNION ALL SELECT 2, '商品详情', s1 FROM c
  UNION ALL SELECT 3, '加购物车', s2 FROM c
  UNION ALL SELECT 4, '订单', s3 FROM oc
  UNION ALL SELECT 5, '支付', s4 FROM oc)""") + f"""
SELECT step_no, step, users, {_pct_sql("users", "(SELECT s0 FROM c)")} AS pct FROM steps"""

SQL["q09_user_paid"] = with_(PAGE_LOG, PAGES, _ORD) + """
SELECT p.uid IS NOT NULL AS paid, count(*) AS users
FROM (SELECT DISTINCT CAST(mid AS BIGINT) AS uid FROM pages) a
LEFT JOIN (SELECT DISTINCT user_id AS uid FROM o WHERE order_status = 'F') p ON a.uid = p.uid
GROUP BY 1"""

SQL["q10_user_total"] = with_(PAGE_LOG, PAGES, _ORD, """
u AS (SELECT CAST(mid AS BIGINT) AS uid, bool_or(is_new = '1') AS is_new FROM pages GROUP BY 1),
pu AS (SELECT user_id AS uid, sum(total_amount) AS amount FROM o GROUP BY 1),
j AS (SELECT u.is_new, pu.amount FROM u FULL OUTER JOIN pu ON u.uid = pu.uid)""") + """
SELECT count(*) FILTER (WHERE is_new IS NOT NULL) AS user_total,
       count(*) FILTER (WHERE amount IS NOT NULL) AS order_user_total,
       count(*) FILTER (WHERE is_new) AS new_user_count,
       count(*) FILTER (WHERE is_new AND amount IS NOT NULL) AS new_order_user_count,
       CAST(sum(amount) AS DOUBLE) / CAST(count(*) FILTER (WHERE amount IS NOT NULL) AS DOUBLE)
         AS pct
FROM j"""

SALES = """
sales AS (SELECT w.*, p.p_brand AS tm_name, p.p_type AS category_name
          FROM order_wide w LEFT JOIN part p ON w.sku_id = p.p_partkey)"""


def _top_sql(key: str) -> str:
    return f"""
SELECT name, CAST(amount AS DOUBLE) AS value FROM (
  SELECT {key} AS name, sum(split_total_amount) AS amount FROM sales GROUP BY 1
  ORDER BY amount DESC, name LIMIT 10)"""


SQL["q11_spu"] = with_(WIDE_CTES, SALES) + _top_sql("sku_name")
SQL["q12_tm"] = with_(WIDE_CTES, SALES) + _top_sql("tm_name")

SQL["q13_category"] = with_(WIDE_CTES, SALES, """
agg AS (SELECT category_name AS name, sum(split_total_amount) AS amount FROM sales GROUP BY 1),
top AS (SELECT * FROM agg ORDER BY amount DESC, name LIMIT 10)""") + """
SELECT name, CAST(amount AS DOUBLE) AS value FROM top
UNION ALL
SELECT '其他', CAST(sum(amount) AS DOUBLE) FROM agg WHERE name NOT IN (SELECT name FROM top)
HAVING sum(amount) IS NOT NULL"""

SQL["q14_area"] = WIDE + """
SELECT province_name, count(DISTINCT order_id) AS order_count FROM order_wide GROUP BY 1"""

SQL["q15_order_total"] = WIDE + """
SELECT count(*) AS order_count, CAST(sum(total_amount) AS DOUBLE) AS order_amount,
       count(DISTINCT user_id) AS order_user
FROM (SELECT order_id, any_value(total_amount) AS total_amount, any_value(user_id) AS user_id
      FROM order_wide GROUP BY order_id)"""


# ---- the dashboard over the last 7 days of its inputs ---------------------------------

_WEEK_PAGES = PAGES.replace("FROM page_log)", """FROM page_log
  WHERE epoch_ms(ts) >= (SELECT max(CAST(ts AS DATE)) - 6 FROM events))""")
_WEEK_ORDERS = "o_orderdate >= (SELECT max(CAST(o_orderdate AS DATE)) - 6 FROM orders)"


def _week(sql: str) -> str:
    """``sql`` with pages and orders bounded to the last 7 days of their tables."""
    return (sql.replace(PAGES, _WEEK_PAGES)
            .replace(_ORD, _ORD.replace("FROM orders)", f"FROM orders WHERE {_WEEK_ORDERS})"))
            .replace("FROM orders o LEFT JOIN customer", f"FROM (SELECT * FROM orders WHERE {_WEEK_ORDERS}) o LEFT JOIN customer"))


for _name in [n for n in SQL if n.startswith("q") and n[1:3].isdigit()]:
    SQL[f"{_name}_7d"] = _week(SQL[_name])


# ---- topic streams, keyed state, shapes, stored searches -------------------------------

_TOPIC = """
SELECT 'ods_base_log' AS topic, CAST(event_id % 3 AS INTEGER) AS "partition", event_id // 3 AS "offset",
       CAST(user_id AS VARCHAR) AS key, event_type
FROM events WHERE """
SQL["stream_latest_start"] = _TOPIC + "event_id >= (SELECT max(event_id) // 3 FROM events)"
SQL["stream_explicit_offsets"] = _TOPIC + "event_id % 3 <> 0 OR event_id // 3 >= 40"

SQL["stream_midnight_expiry"] = with_(PAGE_LOG) + """
SELECT DISTINCT strftime(epoch_ms(ts + 8 * 3600000), '%Y-%m-%d') AS dt, mid, true AS held,
       CAST(0 AS BIGINT) AS devices_left
FROM page_log WHERE last_page_id IS NULL"""
SQL["stream_event_rollup"] = SQL["event_rollup"]
SQL["stream_stage_metrics"] = SQL["stage_counts"] + """
UNION ALL SELECT 'dropped_late', 0"""

_SHAPED = CDC.replace("WHERE op IS NOT NULL)", """WHERE op IS NOT NULL),
shaped AS (
  SELECT *, CASE WHEN seq % 11 = 0 THEN 'no json'
                 WHEN "table" = 'order_info' AND seq % 13 = 0 THEN 'no double: $.total_amount' END AS fault,
         CASE WHEN "table" = 'order_info' THEN amount END AS total_amount,
         CASE WHEN "table" = 'user_info' THEN CASE WHEN o_custkey % 2 = 0 THEN 'M' ELSE 'F' END END AS gender,
         CASE WHEN "table" = 'base_province' THEN CAST(o_custkey % 7 AS INTEGER) END AS area,
         CASE WHEN "table" = 'order_info' THEN 2 ELSE 0 END AS lines
  FROM ops)""")
SQL["cdc_variant_route"] = with_(_SHAPED) + """
SELECT 'DWD_' || upper("table") || '_' || op AS topic, id AS key, seq, total_amount AS amount, gender, area, lines
FROM shaped WHERE fault IS NULL AND "table" IN ('order_info', 'user_info')
UNION ALL
SELECT 'DIM:' || upper("table") || ':' || id, id, seq, total_amount, gender, area, lines
FROM (SELECT *, row_number() OVER (PARTITION BY "table", id ORDER BY seq DESC) AS rn
      FROM shaped WHERE fault IS NULL AND "table" IN ('user_info', 'base_province'))
WHERE rn = 1 AND op <> 'D'"""
SQL["cdc_quarantine"] = with_(_SHAPED) + """
SELECT "table", seq, fault FROM shaped WHERE fault IS NOT NULL"""

SQL["log_quarantine"] = with_(PAGE_LOG) + """,
f AS (SELECT *, CASE WHEN seq % 17 = 0 THEN 'no json'
                     WHEN seq % 10 = 0 AND during_time IS NOT NULL THEN 'no number: page.during_time'
                     WHEN seq % 19 = 0 THEN 'no ts' END AS fault FROM page_log)
SELECT fault, count(*) AS rows FROM f WHERE fault IS NOT NULL GROUP BY fault
UNION ALL SELECT 'page', count(*) FROM f WHERE fault IS NULL AND page_id <> 'error'"""

SQL["bm25_index_rank"] = SQL["bm25_rank"]
SQL["index_match_all"] = WIDE + f"""
SELECT detail_id, sku_name FROM order_wide WHERE list_has_all({W_TOKS}, {_list(_RW)})"""
SQL["fuzzy_index_match"] = SQL["fuzzy_match"]
SQL["fuzzy_index_transpose"] = SQL["fuzzy_transpose"]

_LETTERS = r"[\p{L}\p{N}]+"
_ASKED = "['the', 'license', 'de']"
SQL["highlight_fragments"] = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(text, '[^.!?\n]{{1,100}}(?:[.!?\n]+|[ \t\r]|$)|[^.!?\n]{{1,100}}') AS parts
  FROM documents
  WHERE list_has_any(regexp_extract_all(lower(text), '{_LETTERS}'), {_ASKED})),
p AS (SELECT doc_id, len(parts) AS n_fragments, unnest(parts) AS part, generate_subscripts(parts, 1) AS place FROM d),
s AS (SELECT *, len(list_intersect(list_distinct(regexp_extract_all(lower(part), '{_LETTERS}')), {_ASKED})) AS score FROM p),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, place) = 1)
SELECT doc_id, CAST(n_fragments AS INTEGER) AS n_fragments, CAST(score AS INTEGER) AS score,
       array_to_string(list_transform(regexp_extract_all(part, '{_LETTERS}|[^\p{{L}}\p{{N}}]+'),
         lambda x: CASE WHEN list_contains({_ASKED}, lower(x)) THEN '<em>' || x || '</em>' ELSE x END), '') AS fragment
FROM b"""

SQL["deep_page"] = with_(WIDE_CTES, """
n AS (SELECT count(*) // 2 // 20 * 20 AS skip FROM order_wide),
r AS (SELECT detail_id, split_total_amount,
             row_number() OVER (ORDER BY split_total_amount DESC, detail_id) AS place FROM order_wide)""") + """
SELECT detail_id, CAST(split_total_amount AS DOUBLE) AS split_total_amount
FROM r, n WHERE place > skip AND place <= skip + 20"""
SQL["partition_placement"] = SQL["route_partition_ids"]
