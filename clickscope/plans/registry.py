"""Named queries over a scale-factor folder: ``name -> (spark, sf_dir) -> DataFrame``.

Each entry runs over the whole derived tables of ``sf_dir``; the batch jobs
use the fixture parameters (January 2024, age 20-50, flow 1..7, N = 1000,
blacklist threshold 2).  Twelve entries run real streaming queries
(``availableNow``) whose state and outputs live under the session's
checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickscope.functions.exprs import (after, area_level, before, date_hour, is_empty, json_field, kv_get, kv_set, pad2, parse_time,
                                        product_status, round_half_up, today, trim_comma, yesterday)
from clickscope.operators import ads, area, categories, funnel, sampling, sessions, sinks
from clickscope.params import FIXTURE_PARAMS, TaskParams
from clickscope.plans.area_sql import area_top3_sql
from clickscope.plans.jobs import session_report
from clickscope.session import run_dir
from clickscope.sources.fixtures import Fixture
from clickscope.sources.tables import actions_in_range, area_clicks
from clickscope.streaming import ads_stream

P = FIXTURE_PARAMS
# Parameters of the single-filter queries (other filters empty).
RANGE_PARAMS = replace(P, start_date="2024-01-05", end_date="2024-01-20")
AGE_ONLY = P
KEYWORDS_ONLY = replace(P, start_age=None, end_age=None, keywords="kw1,kw3")
SEX_ONLY = replace(P, start_age=None, end_age=None, sex="male")
ALL_SIX = replace(P, professionals="AUTOMOBILE,BUILDING,MACHINERY",
                  cities=",".join(f"city{i}" for i in range(0, 25, 2)), sex="male",
                  keywords="kw1,kw3", category_ids=",".join(str(i) for i in range(0, 100, 3)))

KV_FIELD = "searchKeywords"


def _fx(spark: SparkSession, sf_dir: str) -> Fixture:
    return Fixture(spark, sf_dir)


def _report(spark, sf_dir, params: TaskParams = P):
    return session_report(spark, sf_dir, params)


def _actions(spark, sf_dir, params: TaskParams = P) -> DataFrame:
    return actions_in_range(_fx(spark, sf_dir).visit_log(), params)


def _filtered_ids(params: TaskParams):
    def q(spark, sf_dir):
        return _report(spark, sf_dir, params).filtered.select("session_id", "user_id")
    return q


# --- sessions -------------------------------------------------------------------

def q_actions_in_range(spark, sf_dir):
    return _actions(spark, sf_dir, RANGE_PARAMS)


def q_session_summary(spark, sf_dir):
    return _report(spark, sf_dir).summary


def q_session_user_join(spark, sf_dir):
    return _report(spark, sf_dir).full


def q_session_buckets(spark, sf_dir):
    return sessions.with_buckets(_report(spark, sf_dir).summary).select("session_id", "visit_bucket", "step_bucket")


def q_session_bucket_counts(spark, sf_dir):
    return sessions.session_bucket_counts(_report(spark, sf_dir).filtered)


def q_session_stats(spark, sf_dir):
    return _report(spark, sf_dir).stats()


def q_actions_of_filtered(spark, sf_dir):
    return _report(spark, sf_dir).filtered_actions.select("session_id", "event_id")


# --- categories -----------------------------------------------------------------

def _cat(fn):
    def q(spark, sf_dir):
        return fn(_report(spark, sf_dir).filtered_actions)
    return q


def q_top_sessions_per_category(spark, sf_dir):
    return _report(spark, sf_dir).written().top_sessions().select("category_id", "session_id", "click_count")


def q_session_category_clicks(spark, sf_dir):
    return _report(spark, sf_dir).written().session_category_clicks()


# --- sampling ---------------------------------------------------------------------

def q_sessions_per_hour(spark, sf_dir):
    return sampling.sessions_per_hour(_report(spark, sf_dir).filtered)


def q_sessions_per_day(spark, sf_dir):
    return sampling.sessions_per_day(_report(spark, sf_dir).filtered)


def q_sample_quota(spark, sf_dir):
    return _report(spark, sf_dir).written().quota()


def q_session_sample(spark, sf_dir):
    return _report(spark, sf_dir).written().sample()


def q_session_sample_detail(spark, sf_dir):
    return _report(spark, sf_dir).written().sample_detail()


def q_job1_stats(spark, sf_dir):
    """JOB1's statistics as observed by the job that writes the filtered sessions."""
    return _report(spark, sf_dir).written().stats()


# --- funnel -------------------------------------------------------------------------

def q_page_transitions(spark, sf_dir):
    return funnel.page_transitions(_actions(spark, sf_dir))


def q_page_pairs(spark, sf_dir):
    return funnel.page_pairs(_actions(spark, sf_dir), P.flow)


def q_start_page_pv(spark, sf_dir):
    return funnel.start_page_pv(_actions(spark, sf_dir), P.flow)


def q_funnel_conversion(spark, sf_dir):
    return funnel.funnel_conversion(_actions(spark, sf_dir), P.flow, rounded=True)


def q_funnel_conversion_raw(spark, sf_dir):
    return funnel.funnel_conversion(_actions(spark, sf_dir), P.flow, rounded=False)


def q_funnel_string(spark, sf_dir):
    return funnel.funnel_string(_actions(spark, sf_dir), P.flow)


# --- area ---------------------------------------------------------------------------

def _area_base(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return area.area_base(area_clicks(fx.visit_log(), P), fx.cities())


def q_area_clicks(spark, sf_dir):
    return area_clicks(_fx(spark, sf_dir).visit_log(), P)


def q_area_base(spark, sf_dir):
    return _area_base(spark, sf_dir)


def q_area_product_clicks(spark, sf_dir):
    return area.area_product_clicks(_area_base(spark, sf_dir))


def q_group_concat_distinct(spark, sf_dir):
    return area.area_city_infos(_area_base(spark, sf_dir))


def q_area_product_info(spark, sf_dir):
    return area.area_product_info(area.area_product_clicks(_area_base(spark, sf_dir)), _fx(spark, sf_dir).products())


def q_area_top3(spark, sf_dir):
    return area.area_top3(q_area_product_info(spark, sf_dir), P.top_products)


def q_area_level(spark, sf_dir):
    return _area_base(spark, sf_dir).select("area", area_level("area").alias("area_level")).distinct()


def q_product_status(spark, sf_dir):
    return _fx(spark, sf_dir).products().select("product_id", product_status("extend_info").alias("product_status"))


def q_json_field(spark, sf_dir):
    return _fx(spark, sf_dir).products().select("product_id", json_field("extend_info", "product_status").alias("value"))


def kv_record() -> Column:
    """An action as a ``k=v|k=v`` record (the original jobs' string record)."""
    return F.concat_ws("|",
                      F.concat(F.lit("sessionid="), F.col("session_id")),
                      F.concat(F.lit("searchKeywords="), F.coalesce(F.col("search_keyword"), F.lit(""))),
                      F.concat(F.lit("clickCategoryIds="),
                               F.when(F.col("click_category_id") != -1, F.col("click_category_id").cast("string"))
                               .otherwise(F.lit(""))),
                      F.concat(F.lit("pageid="), F.col("page_id").cast("string")))


def q_kv_get(spark, sf_dir):
    return _actions(spark, sf_dir).select("event_id", kv_get(kv_record(), KV_FIELD).alias("value"))


NOON = "12:00:00"


def q_scalar_functions(spark, sf_dir):
    """FN1, FN3, FN7-FN10 and FN12 on every action; each is compared with noon of its day."""
    acts = _actions(spark, sf_dir)
    t = parse_time("action_time")
    noon = parse_time(F.concat("date", F.lit(" " + NOON)))
    return acts.select("event_id", before(t, noon).alias("before_noon"), after(t, noon).alias("after_noon"),
                        date_hour(t).alias("date_hour"), is_empty("search_keyword").alias("no_keyword"),
                        trim_comma(F.concat(F.lit(",,"), F.coalesce("order_category_ids", F.lit("")), F.lit(","))).alias("orders"),
                        pad2(F.col("page_id") * 30).alias("padded"),
                        round_half_up(F.col("page_id") * 0.25 - 1, 1).alias("rounded"),
                        kv_set(kv_record(), "pageid", "new").alias("record"))


def q_relative_days(spark, sf_dir):
    """FN4: each action's day against today and yesterday (UTC)."""
    acts = _actions(spark, sf_dir)
    return acts.select("event_id", (F.col("date") < yesterday()).alias("before_yesterday"),
                       F.datediff(today().cast("date"), F.col("date").cast("date")).cast("bigint").alias("days_ago"))


def q_area_top3_sql(spark, sf_dir):
    """JOB5 as SQL text: UDF1-UDF3 called from SQL."""
    return area_top3_sql(spark, sf_dir, P)


# --- ads (batch) -----------------------------------------------------------------

def _clicks(spark, sf_dir) -> DataFrame:
    """Ad clicks parsed from the log lines (ST1 on the static log)."""
    lines = _fx(spark, sf_dir).ad_log()
    return ads.parse_log_lines(lines).where("valid").select("event_id", "ts_ms", "province", "city", "userid",
                                                             "adid", "ts")


def q_ads_user_counts(spark, sf_dir):
    return ads.user_ad_counts(_clicks(spark, sf_dir))


def q_ads_blacklist(spark, sf_dir):
    return ads.blacklist_from_counts(ads.user_ad_counts(_clicks(spark, sf_dir)), P.blacklist_threshold)


def q_ads_blacklist_filter(spark, sf_dir):
    c = _clicks(spark, sf_dir)
    black = ads.blacklist_from_counts(ads.user_ad_counts(c), P.blacklist_threshold)
    return ads.exclude_blacklisted(c, black).select("event_id")


def q_ads_province_counts(spark, sf_dir):
    return ads.province_counts(ads.city_counts(_clicks(spark, sf_dir)))


def q_ads_province_top3(spark, sf_dir):
    return _province_top(_clicks(spark, sf_dir))


def q_ads_sliding_hour(spark, sf_dir):
    return ads.sliding_hour(_clicks(spark, sf_dir))


# The sink keys play "stored table" = clicks of every morning and "new batch" =
# clicks of every afternoon, so the keys of each day meet.
SINK_HOUR = 12


def _halves(spark, sf_dir):
    c = _clicks(spark, sf_dir)
    return c.where(F.hour("ts") < SINK_HOUR), c.where(F.hour("ts") >= SINK_HOUR)


def q_sink_upsert_add(spark, sf_dir):
    old, batch = _halves(spark, sf_dir)
    return sinks.upsert_add(ads.user_ad_counts(old), ads.user_ad_counts(batch), ads.KEY_USER)


def q_sink_upsert_replace(spark, sf_dir):
    old, batch = _halves(spark, sf_dir)
    return sinks.upsert_replace(ads.city_counts(old), ads.city_counts(batch), ads.KEY_CITY)


def _province_top(clicks: DataFrame) -> DataFrame:
    return ads.province_top(ads.province_counts(ads.city_counts(clicks)), P.top_ads)


def q_sink_replace_group(spark, sf_dir):
    old, batch = _halves(spark, sf_dir)
    return sinks.replace_group(_province_top(old), _province_top(batch), ads.PROVINCE_GROUP)


def q_sink_insert_new(spark, sf_dir):
    """Users that the batch's counts bring over the threshold and that are not yet listed."""
    old, batch = (ads.user_ad_counts(c) for c in _halves(spark, sf_dir))
    total = sinks.upsert_add(old, batch, ads.KEY_USER)
    return sinks.insert_new(ads.blacklist_from_counts(old, P.blacklist_threshold),
                            ads.blacklist_from_counts(total, P.blacklist_threshold), ["userid"])


def q_sink_lookup_counts(spark, sf_dir):
    """The stored count of every key of the batch."""
    old, batch = (ads.user_ad_counts(c) for c in _halves(spark, sf_dir))
    return sinks.lookup_counts(batch, old, ads.KEY_USER)


def q_sink_save_table(spark, sf_dir):
    """SNK7: a table saved, dropped and saved again, then read."""
    path = f"{run_dir(spark, 'saved')}/user_counts"
    old, batch = (ads.user_ad_counts(c) for c in _halves(spark, sf_dir))
    sinks.save_table(old, path)
    sinks.save_table(batch, path)
    return spark.read.parquet(path)


# --- ads (streaming) ---------------------------------------------------------------

def _line_stream(spark, sf_dir) -> DataFrame:
    """The ad log of ``sf_dir`` as a file stream of raw text lines."""
    return ads_stream.line_files(spark, _fx(spark, sf_dir).ad_log_path())


def q_ads_stream_parse(spark, sf_dir):
    root = run_dir(spark, "ads-parse")
    lines = _line_stream(spark, sf_dir)
    ads_stream.start_parse_to_files(lines, f"{root}/out", f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/out").where("valid = 'true'").select("event_id", "ts_ms", "province", "city", "userid", "adid")


def q_ads_city_running(spark, sf_dir):
    root = run_dir(spark, "ads-city")
    lines = _line_stream(spark, sf_dir)
    clicks = ads_stream.parsed_clicks(lines)
    ads_stream.start_city_running(clicks, root, f"{root}/_checkpoint", top_n=P.top_ads)
    return ads_stream.city_running_table(spark, root)


def q_ads_minute_trend(spark, sf_dir):
    root = run_dir(spark, "ads-minute")
    lines = _line_stream(spark, sf_dir)
    clicks = ads_stream.parsed_clicks(lines)
    ads_stream.start_minute_trend(clicks, root, f"{root}/_checkpoint")
    return ads_stream.minute_trend_table(spark, root)


def q_ads_blacklist_stream(spark, sf_dir):
    """ST2 on the stream: stage A over the whole ad log, then the blacklist view."""
    root = run_dir(spark, "ads-black")
    ads_stream.start_blacklist_stage(_line_stream(spark, sf_dir), root, P.blacklist_threshold, f"{root}/_checkpoint",
                                     buckets=STREAM_BUCKETS)
    return ads_stream.blacklist_table(spark, root, P.blacklist_threshold)


def q_ads_province_top3_stream(spark, sf_dir):
    """ST3 + ST4 on the stream: province top-3 refreshed per micro-batch."""
    root = run_dir(spark, "ads-top")
    clicks = ads_stream.parsed_clicks(_line_stream(spark, sf_dir))
    ads_stream.start_city_running(clicks, root, f"{root}/_checkpoint", top_n=P.top_ads)
    return ads_stream.province_top_table(spark, root)


def q_ads_sliding_hour_stream(spark, sf_dir):
    """ST5b on the stream: sliding hours from the per-minute state output."""
    root = run_dir(spark, "ads-slide")
    clicks = ads_stream.parsed_clicks(_line_stream(spark, sf_dir))
    ads_stream.start_minute_trend(clicks, root, f"{root}/_checkpoint")
    return ads_stream.sliding_hour_table(spark, root)


#: User buckets of a day in the stream keys (the ad log has a few hundred clicks a day).
STREAM_BUCKETS = 4
#: The multi-batch keys feed the ad log in so many parts (event_id modulo): every
#: part has clicks of all days, so each but the first arrives out of order.
STREAM_PARTS = 4


def _fed_in_parts(spark, sf_dir, root, start) -> None:
    """Append part after part to one folder and let the stream resume from its
    checkpoint after each: one micro-batch a part, compaction in between."""
    log = _fx(spark, sf_dir).ad_log()
    for k in range(STREAM_PARTS):
        log.where(F.col("event_id") % STREAM_PARTS == k).write.mode("append").parquet(f"{root}/in")
        start(ads_stream.line_files(spark, f"{root}/in"))


def q_ads_city_running_multi(spark, sf_dir):
    """ST3 over several out-of-order micro-batches, compacted every two."""
    root = run_dir(spark, "ads-city-multi")
    _fed_in_parts(spark, sf_dir, root, lambda lines: ads_stream.start_city_running(
        ads_stream.parsed_clicks(lines), root, f"{root}/_checkpoint", top_n=P.top_ads, compact_every=2))
    return ads_stream.city_running_table(spark, root)


def q_ads_minute_trend_multi(spark, sf_dir):
    """ST5a over several out-of-order micro-batches, compacted every two."""
    root = run_dir(spark, "ads-minute-multi")
    _fed_in_parts(spark, sf_dir, root, lambda lines: ads_stream.start_minute_trend(
        ads_stream.parsed_clicks(lines), root, f"{root}/_checkpoint", compact_every=2))
    return ads_stream.minute_trend_table(spark, root)


def q_ads_blacklist_multi(spark, sf_dir):
    """ST2 over several micro-batches: a user black-listed by one part has no
    clicks in the next; compacted every two."""
    root = run_dir(spark, "ads-black-multi")
    _fed_in_parts(spark, sf_dir, root, lambda lines: ads_stream.start_blacklist_stage(
        lines, root, P.blacklist_threshold, f"{root}/_checkpoint", compact_every=2, buckets=STREAM_BUCKETS))
    return ads_stream.blacklist_table(spark, root, P.blacklist_threshold)


LATE_DELAY = "1 hour"


def _trend_with_late(spark, sf_dir) -> str:
    """The ad log with state bounded by a watermark of an hour: of every part but the first,
    what is up to 30 days late goes to the late output."""
    root = run_dir(spark, "ads-late")
    _fed_in_parts(spark, sf_dir, root, lambda lines: ads_stream.start_trend_with_late(
        ads_stream.parsed_clicks(lines), root, f"{root}/_checkpoint", LATE_DELAY, compact_every=2))
    return root


def q_ads_minute_trend_late(spark, sf_dir):
    """ST5a with bounded state and late clicks kept."""
    return ads_stream.minute_trend_table(spark, _trend_with_late(spark, sf_dir))


def q_ads_hour_trend_late(spark, sf_dir):
    """ST5a rolled up by a chained event-time aggregate: clicks per (date, hour, ad)."""
    return ads_stream.hour_trend_table(spark, _trend_with_late(spark, sf_dir))


def q_ads_province_top3_multi(spark, sf_dir):
    """ST4 over several out-of-order micro-batches, each from the old top rows and the changes."""
    root = run_dir(spark, "ads-top-multi")
    _fed_in_parts(spark, sf_dir, root, lambda lines: ads_stream.start_city_running(
        ads_stream.parsed_clicks(lines), root, f"{root}/_checkpoint", top_n=P.top_ads, compact_every=2))
    return ads_stream.province_top_table(spark, root, P.top_ads)


def q_ads_job(spark, sf_dir):
    """JOB6 as one job over several micro-batches with blacklist feedback: the running totals."""
    root = run_dir(spark, "ads-job")
    _fed_in_parts(spark, sf_dir, root, lambda lines: ads_stream.run_ads_job(
        spark, lines, threshold=P.blacklist_threshold, top_n=P.top_ads, root=root, buckets=STREAM_BUCKETS))
    return ads_stream.city_running_table(spark, root)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # scans and filters
    "actions_in_range": q_actions_in_range,
    "area_clicks": q_area_clicks,
    "filter_between": _filtered_ids(AGE_ONLY),
    "filter_in_any": _filtered_ids(KEYWORDS_ONLY),
    "filter_equal": _filtered_ids(SEX_ONLY),
    "session_filter": _filtered_ids(ALL_SIX),
    # sessions
    "session_summary": q_session_summary,
    "session_user_join": q_session_user_join,
    "session_buckets": q_session_buckets,
    "session_bucket_counts": q_session_bucket_counts,
    "session_stats": q_session_stats,
    "session_stats_observed": q_job1_stats,
    "actions_of_filtered": q_actions_of_filtered,
    # categories
    "category_universe": _cat(categories.category_universe),
    "category_clicks": _cat(categories.category_clicks),
    "category_orders": _cat(categories.category_orders),
    "category_pays": _cat(categories.category_pays),
    "category_counts": _cat(categories.category_counts),
    "top_categories": _cat(lambda a: categories.top_categories(a, P.top_categories)),
    "session_category_clicks": q_session_category_clicks,
    "top_sessions_per_category": q_top_sessions_per_category,
    # sampling
    "sessions_per_hour": q_sessions_per_hour,
    "sessions_per_day": q_sessions_per_day,
    "sample_quota": q_sample_quota,
    "session_sample": q_session_sample,
    "session_sample_detail": q_session_sample_detail,
    # funnel
    "page_transitions": q_page_transitions,
    "page_pairs": q_page_pairs,
    "start_page_pv": q_start_page_pv,
    "funnel_conversion": q_funnel_conversion,
    "funnel_conversion_raw": q_funnel_conversion_raw,
    "funnel_string": q_funnel_string,
    # area
    "area_base": q_area_base,
    "area_product_clicks": q_area_product_clicks,
    "group_concat_distinct": q_group_concat_distinct,
    "area_product_info": q_area_product_info,
    "area_level": q_area_level,
    "product_status": q_product_status,
    "json_field": q_json_field,
    "kv_get": q_kv_get,
    "scalar_functions": q_scalar_functions,
    "relative_days": q_relative_days,
    "area_top3": q_area_top3,
    "area_top3_sql": q_area_top3_sql,
    # ads
    "ads_stream_parse": q_ads_stream_parse,
    "ads_user_counts": q_ads_user_counts,
    "ads_blacklist": q_ads_blacklist,
    "ads_blacklist_filter": q_ads_blacklist_filter,
    "ads_city_running": q_ads_city_running,
    "ads_province_counts": q_ads_province_counts,
    "ads_province_top3": q_ads_province_top3,
    "ads_minute_trend": q_ads_minute_trend,
    "ads_sliding_hour": q_ads_sliding_hour,
    # the same outputs computed by the streaming queries
    "ads_blacklist_stream": q_ads_blacklist_stream,
    "ads_province_top3_stream": q_ads_province_top3_stream,
    "ads_sliding_hour_stream": q_ads_sliding_hour_stream,
    # several out-of-order micro-batches
    "ads_blacklist_multi": q_ads_blacklist_multi,
    "ads_city_running_multi": q_ads_city_running_multi,
    "ads_minute_trend_multi": q_ads_minute_trend_multi,
    "ads_province_top3_multi": q_ads_province_top3_multi,
    "ads_minute_trend_late": q_ads_minute_trend_late,
    "ads_hour_trend_late": q_ads_hour_trend_late,
    "ads_job": q_ads_job,
    # sinks
    "sink_upsert_add": q_sink_upsert_add,
    "sink_upsert_replace": q_sink_upsert_replace,
    "sink_replace_group": q_sink_replace_group,
    "sink_insert_new": q_sink_insert_new,
    "sink_lookup_counts": q_sink_lookup_counts,
    "sink_save_table": q_sink_save_table,
}
