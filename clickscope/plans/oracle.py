"""Independent DuckDB SQL for every registered query.

The derived tables (visit log, users, products, cities, ad clicks) are
written once more as SQL CTEs over the raw ``events`` / ``customer`` /
``part`` views and prefixed to each query, so the oracle shares no code with
the Spark side; fixed values (cities, labels, dates) are written out again, only
the run parameters are read from the registry.  Ratios use the exact integer HALF_UP form; sums are cast
back to BIGINT (DuckDB widens them).
"""

from __future__ import annotations

from clickscope.params import FIXTURE_PARAMS as P
from clickscope.plans import registry as R

FIXTURE_EPOCH = "2024-01-01"
VISIT_BUCKETS = "1s_3s 4s_6s 7s_9s 10s_30s 30s_60s 1m_3m 3m_10m 10m_30m 30m".split()
STEP_BUCKETS = "1_3 4_6 7_9 10_30 30_60 60".split()
# city rows as SQL text, in the order of their ids
CITIES_VALUES = ("(0, '北京', '华北'), (1, '上海', '华东'), (2, '南京', '华东'), (3, '广州', '华南'), (4, '三亚', '华南'), "
                 "(5, '武汉', '华中'), (6, '长沙', '华中'), (7, '西安', '西北'), (8, '成都', '西南'), (9, '哈尔滨', '东北')")


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in_list(values) -> str:
    return ", ".join(_q(str(v)) for v in values)


def _filter_sql(p) -> str:
    """The six session filters as SQL over ``sess_users`` columns."""
    conds = ["TRUE"]
    if p.start_age is not None and p.end_age is not None:
        conds.append(f"coalesce(age BETWEEN {p.start_age} AND {p.end_age}, FALSE)")
    if p.professional_list:
        conds.append(f"coalesce(professional IN ({_in_list(p.professional_list)}), FALSE)")
    if p.city_list:
        conds.append(f"coalesce(city IN ({_in_list(p.city_list)}), FALSE)")
    if p.sex:
        conds.append(f"coalesce(sex = {_q(p.sex)}, FALSE)")
    if p.keyword_list:
        conds.append(f"coalesce(list_has_any(string_split(search_keywords, ','), [{_in_list(p.keyword_list)}]), FALSE)")
    if p.category_list:
        conds.append(f"coalesce(list_has_any(string_split(click_category_ids, ','), [{_in_list(p.category_list)}]), FALSE)")
    return " AND ".join(conds)


def _hu(n: str, d: str) -> str:
    return f"CASE WHEN ({d}) <> 0 THEN CAST((200 * ({n}) + ({d})) // (2 * ({d})) AS DOUBLE) / 100 END"


def prefix(p=P, start_date=None, end_date=None, filt=None) -> str:
    sd = start_date or p.start_date
    ed = end_date or p.end_date
    fl = [int(x) for x in p.flow]
    steps = ", ".join(
        f"({i}, '{fl[i - 1]}_{fl[i]}', '{'pv' if i == 1 else f'{fl[i - 2]}_{fl[i - 1]}'}')" for i in range(1, len(fl)))
    return f"""
WITH ev AS (
  SELECT event_id, ts, user_id, event_type,
         TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CASE user_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 10 ELSE 30 END AS n,
         CAST(ts AS DATE) AS d
  FROM events),
evb AS (SELECT *, DATE '{FIXTURE_EPOCH}' + CAST(((d - DATE '{FIXTURE_EPOCH}') // n) * n AS INTEGER) AS b FROM ev),
visit_log_all AS (
  SELECT strftime(b, '%Y-%m-%d') AS date, user_id,
         CAST(user_id AS VARCHAR) || '_' || strftime(b, '%Y%m%d') AS session_id,
         k % 10 AS page_id,
         strftime(CAST(b AS TIMESTAMP) + to_hours(user_id % 24)
                  + to_seconds(date_diff('second', CAST(b AS TIMESTAMP), ts) // (40 * n)), '%Y-%m-%d %H:%M:%S') AS action_time,
         CASE WHEN event_type = 'error' THEN 'kw' || CAST(k % 10 AS VARCHAR) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k ELSE -1 END AS click_category_id,
         CASE WHEN event_type = 'click' THEN k * 2 ELSE -1 END AS click_product_id,
         CASE WHEN event_type = 'signup' THEN CAST(k AS VARCHAR) || ',' || CAST((k * 7 + 1) % 100 AS VARCHAR) END AS order_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST(k AS VARCHAR) || ',' || CAST((k * 7 + 1) % 100 AS VARCHAR) END AS order_product_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) END AS pay_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) END AS pay_product_ids,
         user_id % 10 AS city_id,
         event_id
  FROM evb),
visit_log AS (SELECT * FROM visit_log_all WHERE date >= '{sd}' AND date <= '{ed}'),
users AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name AS name, CAST((c_custkey * 37) % 60 AS INTEGER) AS age,
         c_mktsegment AS professional, 'city' || CAST(c_nationkey AS VARCHAR) AS city,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer),
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
         '{{"product_status":' || CAST(p_size % 2 AS VARCHAR) || '}}' AS extend_info
  FROM part),
cities AS (SELECT * FROM (VALUES {CITIES_VALUES}) t(city_id, city_name, area)),
sess AS (
  SELECT session_id, min(user_id) AS user_id,
         coalesce(array_to_string(list_sort(list_distinct(list(search_keyword) FILTER (WHERE search_keyword IS NOT NULL AND search_keyword <> ''))), ','), '') AS search_keywords,
         coalesce(array_to_string(list_sort(list_distinct(list(click_category_id) FILTER (WHERE click_category_id <> -1))), ','), '') AS click_category_ids,
         CAST(date_diff('second', min(strptime(action_time, '%Y-%m-%d %H:%M:%S')), max(strptime(action_time, '%Y-%m-%d %H:%M:%S'))) AS BIGINT) AS visit_length,
         CAST(count(*) AS BIGINT) AS step_length,
         strftime(min(strptime(action_time, '%Y-%m-%d %H:%M:%S')), '%Y-%m-%d %H:%M:%S') AS start_time
  FROM visit_log GROUP BY session_id),
sess_users AS (
  SELECT s.*, u.age, u.professional, u.sex, u.city FROM sess s JOIN users u ON s.user_id = u.user_id),
sess_f AS (SELECT * FROM sess_users WHERE {_filter_sql(filt or p)}),
buckets AS (
  SELECT session_id,
    CASE WHEN visit_length BETWEEN 1 AND 3 THEN '1s_3s' WHEN visit_length BETWEEN 4 AND 6 THEN '4s_6s'
         WHEN visit_length BETWEEN 7 AND 9 THEN '7s_9s' WHEN visit_length BETWEEN 10 AND 30 THEN '10s_30s'
         WHEN visit_length > 30 AND visit_length <= 60 THEN '30s_60s' WHEN visit_length > 60 AND visit_length <= 180 THEN '1m_3m'
         WHEN visit_length > 180 AND visit_length <= 600 THEN '3m_10m' WHEN visit_length > 600 AND visit_length <= 1800 THEN '10m_30m'
         WHEN visit_length > 1800 THEN '30m' END AS visit_bucket,
    CASE WHEN step_length BETWEEN 1 AND 3 THEN '1_3' WHEN step_length BETWEEN 4 AND 6 THEN '4_6'
         WHEN step_length BETWEEN 7 AND 9 THEN '7_9' WHEN step_length BETWEEN 10 AND 30 THEN '10_30'
         WHEN step_length > 30 AND step_length <= 60 THEN '30_60' WHEN step_length > 60 THEN '60' END AS step_bucket
  FROM sess_f),
acts_f AS (SELECT * FROM visit_log WHERE session_id IN (SELECT session_id FROM sess_f)),
kinds AS (
  SELECT click_category_id AS category_id, 0 AS kind FROM acts_f WHERE click_category_id <> -1
  UNION ALL SELECT TRY_CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT), 1 FROM acts_f WHERE order_category_ids IS NOT NULL
  UNION ALL SELECT TRY_CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT), 2 FROM acts_f WHERE pay_category_ids IS NOT NULL),
cat_counts AS (
  SELECT category_id, CAST(count(*) FILTER (WHERE kind = 0) AS BIGINT) AS click_count,
         CAST(count(*) FILTER (WHERE kind = 1) AS BIGINT) AS order_count,
         CAST(count(*) FILTER (WHERE kind = 2) AS BIGINT) AS pay_count
  FROM kinds WHERE category_id IS NOT NULL GROUP BY category_id),
top_cat AS (SELECT * FROM cat_counts ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT {P.top_categories}),
sess_cat AS (
  SELECT click_category_id AS category_id, session_id, CAST(count(*) AS BIGINT) AS click_count
  FROM acts_f WHERE click_category_id IN (SELECT category_id FROM top_cat) GROUP BY 1, 2),
hours AS (SELECT substr(start_time, 1, 10) AS date, substr(start_time, 12, 2) AS hour, CAST(count(*) AS BIGINT) AS cnt
          FROM sess_f GROUP BY 1, 2),
quota AS (
  SELECT date, hour, cnt,
         CAST(least(cnt, (cnt * ({P.sample_size} // (SELECT count(DISTINCT date) FROM hours)))
                         // CAST(sum(cnt) OVER (PARTITION BY date) AS BIGINT)) AS BIGINT) AS quota
  FROM hours),
sample AS (
  SELECT s.session_id, s.start_time, s.search_keywords, s.click_category_ids FROM (
    SELECT *, substr(start_time, 1, 10) AS date, substr(start_time, 12, 2) AS hour,
           row_number() OVER (PARTITION BY substr(start_time, 1, 10), substr(start_time, 12, 2)
                              ORDER BY md5({_q(P.sample_seed)} || session_id), session_id) AS rn
    FROM sess_f) s JOIN quota q ON s.date = q.date AND s.hour = q.hour WHERE s.rn <= q.quota),
trans AS (
  SELECT session_id, event_id, CAST(page_id AS VARCHAR) || '_' || CAST(nxt AS VARCHAR) AS pair FROM (
    SELECT session_id, event_id, page_id,
           lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, event_id) AS nxt
    FROM visit_log) t WHERE nxt IS NOT NULL),
flow_steps AS (SELECT * FROM (VALUES {steps}) t(step, pair, prev_pair)),
pairs AS (SELECT pair, CAST(count(*) AS BIGINT) AS cnt FROM trans WHERE pair IN (SELECT pair FROM flow_steps) GROUP BY pair),
pv AS (SELECT CAST({fl[0]} AS BIGINT) AS page_id, CAST(count(*) AS BIGINT) AS pv FROM visit_log WHERE page_id = {fl[0]}),
fcounts AS (SELECT pair, cnt FROM pairs UNION ALL SELECT 'pv', pv FROM pv),
funnel AS (
  SELECT CAST(f.step AS INTEGER) AS step, f.pair, CAST(coalesce(c.cnt, 0) AS BIGINT) AS cnt,
         CAST(coalesce(pc.cnt, 0) AS BIGINT) AS den
  FROM flow_steps f LEFT JOIN fcounts c ON f.pair = c.pair LEFT JOIN fcounts pc ON f.prev_pair = pc.pair),
area_base AS (
  SELECT CAST(c.city_id AS BIGINT) AS city_id, c.city_name, c.area, a.click_product_id AS pid
  FROM visit_log a JOIN cities c ON a.city_id = c.city_id WHERE a.click_product_id <> -1),
apc AS (
  SELECT area, pid, CAST(count(*) AS BIGINT) AS click_count,
         array_to_string(list_sort(list_distinct(list(CAST(city_id AS VARCHAR) || ':' || city_name))), ',') AS city_infos
  FROM area_base GROUP BY area, pid),
api AS (
  SELECT a.area, a.pid, a.click_count, a.city_infos, p.product_name,
         CASE WHEN json_extract_string(p.extend_info, '$.product_status') = '0' THEN 'Self' ELSE 'Third Party' END AS product_status
  FROM apc a JOIN products p ON a.pid = p.product_id),
ad_clicks AS (
  SELECT event_id, epoch_us(ts) // 1000 AS ts_ms, 'p' || CAST((event_id % 30) // 3 AS VARCHAR) AS province,
         'c' || CAST(event_id % 30 AS VARCHAR) AS city, user_id AS userid, k % 20 AS adid,
         make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts, strftime(ts, '%Y%m%d') AS date
  FROM ev),
user_counts AS (SELECT date, userid, adid, CAST(count(*) AS BIGINT) AS click_count FROM ad_clicks GROUP BY 1, 2, 3),
blacklist AS (SELECT DISTINCT userid FROM user_counts WHERE click_count > {P.blacklist_threshold}),
city_counts AS (SELECT date, province, city, adid, CAST(count(*) AS BIGINT) AS click_count FROM ad_clicks GROUP BY 1, 2, 3, 4),
prov_counts AS (SELECT date, province, adid, CAST(sum(click_count) AS BIGINT) AS click_count FROM city_counts GROUP BY 1, 2, 3),
prov_top AS (
  SELECT date, province, adid, click_count FROM (
    SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, adid) AS rn FROM prov_counts) t
  WHERE rn <= {P.top_ads}),
half_old AS (SELECT * FROM ad_clicks WHERE hour(ts) < 12),
half_new AS (SELECT * FROM ad_clicks WHERE hour(ts) >= 12)
"""


def _prov_top(src: str) -> str:
    return f"""(SELECT date, province, adid, click_count FROM (
      SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, adid) AS rn FROM (
        SELECT date, province, adid, CAST(count(*) AS BIGINT) AS click_count FROM {src} GROUP BY 1, 2, 3) a) b
      WHERE rn <= {P.top_ads})"""


_VISIT_COLS = ("date, user_id, session_id, page_id, action_time, search_keyword, click_category_id, click_product_id, "
               "order_category_ids, order_product_ids, pay_category_ids, pay_product_ids, city_id, event_id")

_STATS = ", ".join(
    [f"{_hu(f'count(*) FILTER (WHERE visit_bucket = {_q(b)})', 'count(*)')} AS visit_length_{b}_ratio" for b in VISIT_BUCKETS]
    + [f"{_hu(f'count(*) FILTER (WHERE step_bucket = {_q(b)})', 'count(*)')} AS step_length_{b}_ratio" for b in STEP_BUCKETS])

BODIES: dict[str, str] = {
    "actions_in_range": f"SELECT {_VISIT_COLS} FROM visit_log",
    "area_clicks": "SELECT city_id, click_product_id FROM visit_log WHERE click_product_id <> -1",
    "filter_between": "SELECT session_id, user_id FROM sess_f",
    "filter_in_any": "SELECT session_id, user_id FROM sess_f",
    "filter_equal": "SELECT session_id, user_id FROM sess_f",
    "session_filter": "SELECT session_id, user_id FROM sess_f",
    "session_summary": "SELECT * FROM sess",
    "session_user_join": "SELECT * FROM sess_users",
    "session_buckets": """SELECT session_id,
        CASE WHEN visit_length BETWEEN 1 AND 3 THEN '1s_3s' WHEN visit_length BETWEEN 4 AND 6 THEN '4s_6s'
         WHEN visit_length BETWEEN 7 AND 9 THEN '7s_9s' WHEN visit_length BETWEEN 10 AND 30 THEN '10s_30s'
         WHEN visit_length > 30 AND visit_length <= 60 THEN '30s_60s' WHEN visit_length > 60 AND visit_length <= 180 THEN '1m_3m'
         WHEN visit_length > 180 AND visit_length <= 600 THEN '3m_10m' WHEN visit_length > 600 AND visit_length <= 1800 THEN '10m_30m'
         WHEN visit_length > 1800 THEN '30m' END AS visit_bucket,
        CASE WHEN step_length BETWEEN 1 AND 3 THEN '1_3' WHEN step_length BETWEEN 4 AND 6 THEN '4_6'
         WHEN step_length BETWEEN 7 AND 9 THEN '7_9' WHEN step_length BETWEEN 10 AND 30 THEN '10_30'
         WHEN step_length > 30 AND step_length <= 60 THEN '30_60' WHEN step_length > 60 THEN '60' END AS step_bucket
      FROM sess""",
    "session_bucket_counts": """SELECT bucket, CAST(count(*) AS BIGINT) AS cnt FROM (
        SELECT 'session_count' AS bucket FROM buckets
        UNION ALL SELECT visit_bucket FROM buckets WHERE visit_bucket IS NOT NULL
        UNION ALL SELECT step_bucket FROM buckets WHERE step_bucket IS NOT NULL) t GROUP BY bucket""",
    "session_stats": f"SELECT CAST(count(*) AS BIGINT) AS session_count, {_STATS} FROM buckets",
    "actions_of_filtered": "SELECT session_id, event_id FROM acts_f",
    "category_universe": "SELECT DISTINCT category_id FROM kinds WHERE category_id IS NOT NULL",
    "category_clicks": "SELECT category_id, CAST(count(*) AS BIGINT) AS cnt FROM kinds WHERE kind = 0 GROUP BY 1",
    "category_orders": "SELECT category_id, CAST(count(*) AS BIGINT) AS cnt FROM kinds WHERE kind = 1 AND category_id IS NOT NULL GROUP BY 1",
    "category_pays": "SELECT category_id, CAST(count(*) AS BIGINT) AS cnt FROM kinds WHERE kind = 2 AND category_id IS NOT NULL GROUP BY 1",
    "category_counts": "SELECT * FROM cat_counts",
    "top_categories": "SELECT * FROM top_cat",
    "session_category_clicks": "SELECT * FROM sess_cat",
    "top_sessions_per_category": """SELECT category_id, session_id, click_count FROM (
        SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) AS rn FROM sess_cat) t
      WHERE rn <= 10""".replace("10", str(P.top_sessions)),
    "sessions_per_hour": "SELECT * FROM hours",
    "sessions_per_day": "SELECT substr(start_time, 1, 10) AS date, CAST(count(*) AS BIGINT) AS cnt FROM sess_f GROUP BY 1",
    "sample_quota": "SELECT * FROM quota",
    "session_sample": "SELECT * FROM sample",
    "session_sample_detail": """SELECT session_id, user_id, page_id, action_time, search_keyword, click_category_id, click_product_id,
        order_category_ids, order_product_ids, pay_category_ids, pay_product_ids
      FROM visit_log WHERE session_id IN (SELECT session_id FROM sample)""",
    "page_transitions": "SELECT * FROM trans",
    "page_pairs": "SELECT * FROM pairs",
    "start_page_pv": "SELECT * FROM pv",
    "funnel_conversion": f"SELECT step, pair, cnt, {_hu('cnt', 'den')} AS rate FROM funnel",
    "funnel_conversion_raw": "SELECT step, pair, cnt, CAST(cnt AS DOUBLE) / nullif(CAST(den AS DOUBLE), 0) AS rate FROM funnel",
    "funnel_string": f"""SELECT string_agg(pair || '=' || coalesce(printf('%.2f', {_hu('cnt', 'den')}), 'null'), '|' ORDER BY step)
        AS convert_rate FROM funnel""",
    "area_base": "SELECT * FROM area_base",
    "area_product_clicks": "SELECT * FROM apc",
    "group_concat_distinct": """SELECT area, array_to_string(list_sort(list_distinct(list(CAST(city_id AS VARCHAR) || ':' || city_name))), ',')
        AS city_infos FROM area_base GROUP BY area""",
    "area_product_info": "SELECT * FROM api",
    "area_level": """SELECT DISTINCT area, CASE WHEN area IN ('华北', '华东') THEN 'A_Level' WHEN area IN ('华中', '华南') THEN 'B_Level'
        WHEN area IN ('西南', '西北') THEN 'C_Level' ELSE 'D_Level' END AS area_level FROM area_base""",
    "product_status": """SELECT product_id, CASE WHEN json_extract_string(extend_info, '$.product_status') = '0' THEN 'Self'
        ELSE 'Third Party' END AS product_status FROM products""",
    "json_field": "SELECT product_id, json_extract_string(extend_info, '$.product_status') AS value FROM products",
    "kv_get": f"""SELECT event_id, string_split(rtrim(pair_text, '='), '=')[2] AS value FROM (SELECT event_id,
        list_filter(string_split(record, '|'),
                    lambda p: len(string_split(rtrim(p, '='), '=')) = 2
                              AND string_split(rtrim(p, '='), '=')[1] = 'searchKeywords')[1] AS pair_text
      FROM (SELECT event_id,
                   'sessionid=' || session_id || '|searchKeywords=' || coalesce(search_keyword, '')
                   || '|clickCategoryIds=' || CASE WHEN click_category_id <> -1 THEN CAST(click_category_id AS VARCHAR) ELSE '' END
                   || '|pageid=' || CAST(page_id AS VARCHAR) AS record
            FROM visit_log) r) k""",
    "area_top3": """SELECT area, CASE WHEN area IN ('华北', '华东') THEN 'A_Level' WHEN area IN ('华中', '华南') THEN 'B_Level'
        WHEN area IN ('西南', '西北') THEN 'C_Level' ELSE 'D_Level' END AS area_level,
        pid, city_infos, click_count, product_name, product_status FROM (
        SELECT *, row_number() OVER (PARTITION BY area ORDER BY click_count DESC, pid) AS rn FROM api) t WHERE rn <= 3"""
        .replace("rn <= 3", f"rn <= {P.top_products}"),
    "ads_stream_parse": "SELECT event_id, ts_ms, province, city, userid, adid FROM ad_clicks",
    "ads_user_counts": "SELECT * FROM user_counts",
    "ads_blacklist": "SELECT * FROM blacklist",
    "ads_blacklist_filter": "SELECT event_id FROM ad_clicks WHERE userid NOT IN (SELECT userid FROM blacklist)",
    "ads_city_running": "SELECT * FROM city_counts",
    "ads_province_counts": "SELECT * FROM prov_counts",
    "ads_province_top3": "SELECT * FROM prov_top",
    "ads_minute_trend": """SELECT strftime(m, '%Y%m%d') AS date, strftime(m, '%H') AS hour, strftime(m, '%M') AS minute, adid,
        CAST(count(*) AS BIGINT) AS click_count FROM (SELECT date_trunc('minute', ts) AS m, adid FROM ad_clicks) t GROUP BY 1, 2, 3, 4""",
    "ads_sliding_hour": """SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start,
        strftime(ws + INTERVAL 60 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end, adid, CAST(count(*) AS BIGINT) AS click_count
      FROM (SELECT date_trunc('minute', ts) - to_minutes(o) AS ws, adid FROM ad_clicks, range(60) r(o)) t GROUP BY ws, adid""",
    "sink_upsert_add": """SELECT date, userid, adid, CAST(sum(click_count) AS BIGINT) AS click_count FROM (
        SELECT date, userid, adid, count(*) AS click_count FROM half_old GROUP BY 1, 2, 3
        UNION ALL SELECT date, userid, adid, count(*) FROM half_new GROUP BY 1, 2, 3) t GROUP BY 1, 2, 3""",
    "sink_upsert_replace": """SELECT * FROM (
        SELECT date, province, city, adid, CAST(count(*) AS BIGINT) AS click_count FROM half_old GROUP BY 1, 2, 3, 4) o
      WHERE NOT EXISTS (SELECT 1 FROM half_new n WHERE n.date = o.date AND n.province = o.province
                        AND n.city = o.city AND n.adid = o.adid)
      UNION ALL SELECT date, province, city, adid, CAST(count(*) AS BIGINT) FROM half_new GROUP BY 1, 2, 3, 4""",
    "sink_replace_group": f"""SELECT * FROM {_prov_top('half_old')} o
      WHERE NOT EXISTS (SELECT 1 FROM half_new n WHERE n.date = o.date AND n.province = o.province)
      UNION ALL SELECT * FROM {_prov_top('half_new')} n2""",
}

BODIES["area_top3_sql"] = BODIES["area_top3"]
BODIES["scalar_functions"] = """SELECT event_id,
        strptime(action_time, '%Y-%m-%d %H:%M:%S') < CAST(date AS TIMESTAMP) + INTERVAL 12 HOUR AS before_noon,
        strptime(action_time, '%Y-%m-%d %H:%M:%S') > CAST(date AS TIMESTAMP) + INTERVAL 12 HOUR AS after_noon,
        substr(action_time, 1, 10) || '_' || substr(action_time, 12, 2) AS date_hour,
        search_keyword IS NULL OR search_keyword = '' AS no_keyword,
        coalesce(order_category_ids, '') AS orders,
        CASE WHEN length(CAST(page_id * 30 AS VARCHAR)) = 2 THEN '' ELSE '0' END || CAST(page_id * 30 AS VARCHAR) AS padded,
        CAST(sign(page_id * 25 - 100) * ((abs(page_id * 25 - 100) + 5) // 10) AS DOUBLE) / 10 AS rounded,
        'sessionid=' || session_id || '|searchKeywords=' || coalesce(search_keyword, '')
          || '|clickCategoryIds=' || CASE WHEN click_category_id <> -1 THEN CAST(click_category_id AS VARCHAR) ELSE '' END
          || '|pageid=new' AS record
      FROM visit_log"""
BODIES["sink_insert_new"] = f"""SELECT DISTINCT userid FROM (
        SELECT date, userid, adid FROM ad_clicks GROUP BY 1, 2, 3 HAVING count(*) > {P.blacklist_threshold}) t
      WHERE userid NOT IN (SELECT userid FROM half_old GROUP BY date, userid, adid HAVING count(*) > {P.blacklist_threshold})"""
BODIES["sink_lookup_counts"] = """SELECT n.date, n.userid, n.adid, coalesce(o.cnt, 0) AS click_count
      FROM (SELECT DISTINCT date, userid, adid FROM half_new) n
      LEFT JOIN (SELECT date, userid, adid, count(*) AS cnt FROM half_old GROUP BY 1, 2, 3) o
      ON n.date = o.date AND n.userid = o.userid AND n.adid = o.adid"""

BODIES["sink_save_table"] = "SELECT date, userid, adid, CAST(count(*) AS BIGINT) AS click_count FROM half_new GROUP BY 1, 2, 3"
_TODAY = "CAST(now() AT TIME ZONE 'UTC' AS DATE)"
BODIES["relative_days"] = f"""SELECT event_id, CAST(date AS DATE) < {_TODAY} - 1 AS before_yesterday,
        CAST({_TODAY} - CAST(date AS DATE) AS BIGINT) AS days_ago FROM visit_log"""

# streaming forms of batch outputs: same result, same SQL
BODIES["ads_blacklist_stream"] = BODIES["ads_blacklist"]
BODIES["ads_city_running_multi"] = BODIES["ads_city_running"]
BODIES["ads_minute_trend_multi"] = BODIES["ads_minute_trend"]
BODIES["ads_minute_trend_late"] = BODIES["ads_minute_trend"]
BODIES["ads_hour_trend_late"] = """SELECT strftime(ts, '%Y%m%d') AS date, strftime(ts, '%H') AS hour, adid,
        CAST(count(*) AS BIGINT) AS click_count FROM ad_clicks GROUP BY 1, 2, 3"""
BODIES["ads_province_top3_multi"] = BODIES["ads_province_top3"]
BODIES["session_stats_observed"] = BODIES["session_stats"]


def _fed_back(select: str, parts: int = 4, threshold: int = 2) -> str:
    """The ad log in ``parts`` (event_id modulo); each part without the users over the threshold so far."""
    ctes = ["c0 AS (SELECT * FROM ad_clicks WHERE event_id % 4 = 0)"]
    for k in range(parts):
        so_far = " UNION ALL ".join(f"SELECT * FROM c{j}" for j in range(k + 1))
        ctes.append(f"b{k} AS (SELECT DISTINCT userid FROM (SELECT userid FROM ({so_far}) x "
                    f"GROUP BY date, userid, adid HAVING count(*) > {threshold}) y)")
        if k + 1 < parts:
            ctes.append(f"c{k + 1} AS (SELECT * FROM ad_clicks WHERE event_id % {parts} = {k + 1} "
                        f"AND userid NOT IN (SELECT userid FROM b{k}))")
    every = " UNION ALL ".join(f"SELECT * FROM c{j}" for j in range(parts))
    return f"SELECT * FROM (WITH {', '.join(ctes)} {select.format(last=f'b{parts - 1}', every=every)}) z"


BODIES["ads_blacklist_multi"] = _fed_back("SELECT userid FROM {last}")
BODIES["ads_job"] = _fed_back("SELECT date, province, city, adid, CAST(count(*) AS BIGINT) AS click_count "
                              "FROM ({every}) e GROUP BY 1, 2, 3, 4")
BODIES["ads_province_top3_stream"] = BODIES["ads_province_top3"]
BODIES["ads_sliding_hour_stream"] = BODIES["ads_sliding_hour"]

# queries whose parameters differ from the fixture defaults
_PREFIX_ARGS = {
    "actions_in_range": dict(start_date=R.RANGE_PARAMS.start_date, end_date=R.RANGE_PARAMS.end_date),
    "filter_between": dict(filt=R.AGE_ONLY),
    "filter_in_any": dict(filt=R.KEYWORDS_ONLY),
    "filter_equal": dict(filt=R.SEX_ONLY),
    "session_filter": dict(filt=R.ALL_SIX),
}


def oracle_sql() -> dict[str, str]:
    return {k: prefix(**_PREFIX_ARGS.get(k, {})) + body for k, body in BODIES.items()}
