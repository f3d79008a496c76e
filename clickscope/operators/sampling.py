"""Sessions per hour and the repeatable stratified session sample
(AGG8, SMP1-SMP3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F



def sessions_per_hour(sessions: DataFrame) -> DataFrame:
    """AGG8: sessions by start date and start hour."""
    return (sessions.select(F.substring("start_time", 1, 10).alias("date"),
                            F.substring("start_time", 12, 2).alias("hour"))
            .groupBy("date", "hour").agg(F.count(F.lit(1)).alias("cnt")))


def sessions_per_day(sessions: DataFrame) -> DataFrame:
    """AGG8 (per date): sessions by start date."""
    return (sessions.select(F.substring("start_time", 1, 10).alias("date"))
            .groupBy("date").agg(F.count(F.lit(1)).alias("cnt")))


def sample_quota(sessions: DataFrame, sample_size: int) -> DataFrame:
    """SMP1: sessions to draw per (date, hour).

    ``per_day = sample_size div days``; an hour draws
    ``min(cnt, cnt * per_day div day_cnt)`` (exact integer arithmetic).
    ``per_day`` is one scalar sub-query (evaluated once), the day total a
    window over the date - both over the tiny per-hour table."""
    hours = sessions_per_hour(sessions)
    per_day = hours.select(F.expr(f"{int(sample_size)} div count(DISTINCT date)")).scalar()
    return (hours.withColumn("per_day", per_day)
            .withColumn("day_cnt", F.sum("cnt").over(Window.partitionBy("date")))
            .select("date", "hour", "cnt",
                    F.expr("least(cnt, (cnt * per_day) div day_cnt)").cast("bigint").alias("quota")))


#: Standard deviations by which the candidates of an hour exceed its quota.
SPARE = 6.0


def with_cutoff(quota: DataFrame, spare: float = SPARE) -> DataFrame:
    """``quota`` with ``cutoff``: a bound on the md5 text below which about the quota and
    ``spare`` deviations more of the hour's sessions lie ('g' is above every md5)."""
    share = f"(quota + {float(spare)} * sqrt(quota) + {float(spare)}) / cnt"
    bits = f"lpad(lower(hex(cast({share} * {1 << 48} as bigint))), 12, '0')"
    return quota.withColumn("cutoff", F.expr(f"case when quota = 0 or {share} <= 0 then '' when {share} >= 1 then 'g' else {bits} end"))


def session_sample(sessions: DataFrame, sample_size: int, seed: str, spare: float = SPARE) -> DataFrame:
    """SMP2: per (date, hour), the ``quota`` sessions with the smallest
    ``md5(seed || session_id)`` (ties by id): a seeded, repeatable sample
    without replacement.

    The quota comes first; only sessions under the hour's cutoff, a little more than the
    quota, are ranked.  Hours in which chance left fewer than the quota under it are ranked
    whole, so the sample is exact whatever the cutoff.
    ``sessions`` is read three times: write it first (``SessionReport.written``)."""
    s = sessions.select("session_id", "start_time", "search_keywords", "click_category_ids",
                        F.substring("start_time", 1, 10).alias("date"),
                        F.substring("start_time", 12, 2).alias("hour"),
                        F.md5(F.concat(F.lit(seed), F.col("session_id"))).alias("draw"))
    # the quota table has one row per (date, hour): bounded by hours in range
    quota = with_cutoff(sample_quota(sessions, sample_size).select("date", "hour", "cnt", "quota"), spare)
    under = (s.select("date", "hour", "draw").join(F.broadcast(quota), ["date", "hour"]).where("draw < cutoff")
             .groupBy("date", "hour").agg(F.count(F.lit(1)).alias("under")))
    quota = (quota.join(F.broadcast(under), ["date", "hour"], "left")
             .withColumn("cutoff", F.expr("case when coalesce(under, 0) < quota then 'g' else cutoff end")).select("date", "hour", "quota", "cutoff"))
    near = s.join(F.broadcast(quota), ["date", "hour"]).where("draw < cutoff")
    w = Window.partitionBy("date", "hour").orderBy("draw", "session_id")
    ranked = near.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= int(sample_size))
    return ranked.where("rn <= quota").select("session_id", "start_time", "search_keywords", "click_category_ids")


def session_sample_detail(actions: DataFrame, sample: DataFrame, sample_size: int) -> DataFrame:
    """SMP3: full action rows of the sampled sessions (``sample_size`` at most); the
    semi-join broadcasts them when their measured size allows it."""
    ids = sample.select("session_id")
    return actions.join(ids, "session_id", "left_semi").select(
        "session_id", "user_id", "page_id", "action_time", "search_keyword", "click_category_id",
        "click_product_id", "order_category_ids", "order_product_ids", "pay_category_ids", "pay_product_ids")
