"""Session summary, user join, session filters and session statistics
(AGG1-AGG3, JON1, JON2, FLT1-FLT4, PRJ3)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscope.functions.exprs import (
    STEP_BUCKETS, VISIT_BUCKETS, between_or_true, csv_overlap, equal_or_true, format_time,
    half_up_ratio, in_any, parse_time, step_bucket, visit_bucket,
)
from clickscope.params import TaskParams

SUMMARY_COLUMNS = ["session_id", "user_id", "search_keywords", "click_category_ids",
                   "visit_length", "step_length", "start_time"]


def session_summary(actions: DataFrame) -> DataFrame:
    """AGG1: one row per session.

    ``search_keywords`` / ``click_category_ids``: distinct values, sorted,
    comma-joined ('' when none); ``visit_length``: whole seconds between the
    first and the last action; ``step_length``: number of actions.

    Two levels: a hash aggregate of fixed-width values per (session, keyword, category)
    comes first, so raw rows never meet a set, and a session with very many
    keywords is spread over the tasks; then each session gathers what it has once."""
    t = parse_time("action_time")
    clicked = F.when(F.col("click_category_id") != -1, F.col("click_category_id"))
    keyword = F.when(F.coalesce(F.col("search_keyword"), F.lit("")) != "", F.col("search_keyword"))
    once = actions.groupBy("session_id", keyword.alias("_keyword"), clicked.alias("_clicked")).agg(
        F.min("user_id").alias("user_id"), F.min(t).alias("_start"), F.max(t).alias("_end"), F.count(F.lit(1)).alias("_n"))
    agg = once.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.array_join(F.array_sort(F.collect_set("_keyword")), ",").alias("search_keywords"),
        F.array_join(F.transform(F.array_sort(F.collect_set("_clicked")), lambda x: x.cast("string")), ",")
        .alias("click_category_ids"),
        F.min("_start").alias("_start"),
        F.max("_end").alias("_end"),
        F.sum("_n").alias("step_length"),
    )
    return agg.select(
        "session_id", "user_id", "search_keywords", "click_category_ids",
        F.timestamp_diff("SECOND", F.col("_start"), F.col("_end")).cast("bigint").alias("visit_length"),
        F.col("step_length").cast("bigint").alias("step_length"),
        format_time("_start").alias("start_time"),
    )


def with_users(summary: DataFrame, users: DataFrame) -> DataFrame:
    """JON1: attach age, professional, sex, city; sessions of unknown users drop.

    Equi-join on ``user_id``; AQE turns it into a broadcast join only when the
    measured user side is under the broadcast threshold."""
    u = users.select("user_id", "age", "professional", "sex", "city")
    return summary.join(u, "user_id", "inner").select(*SUMMARY_COLUMNS, "age", "professional", "sex", "city")


def session_predicate(params: TaskParams) -> Column:
    """FLT4: conjunction of the six optional session filters."""
    preds = [
        between_or_true("age", params.start_age, params.end_age),
        in_any("professional", params.professional_list),
        in_any("city", params.city_list),
        equal_or_true("sex", params.sex),
        csv_overlap("search_keywords", params.keyword_list),
        csv_overlap("click_category_ids", params.category_list),
    ]
    return reduce(lambda a, b: a & b, preds)


def filter_sessions(full: DataFrame, params: TaskParams) -> DataFrame:
    return full.where(session_predicate(params))


def with_buckets(sessions: DataFrame) -> DataFrame:
    """PRJ3: visit-length and step-length bucket labels (0 s has no bucket)."""
    return sessions.withColumn("visit_bucket", visit_bucket("visit_length")) \
                   .withColumn("step_bucket", step_bucket("step_length"))


def session_bucket_counts(sessions: DataFrame) -> DataFrame:
    """AGG2: counts per bucket label plus ``session_count`` (the accumulator map).

    Each session contributes up to three labels; the group-by is a partial +
    final hash aggregate over at most 16 keys."""
    b = with_buckets(sessions)
    labels = F.array(F.lit("session_count"), F.col("visit_bucket"), F.col("step_bucket"))
    return (b.select(F.explode(labels).alias("bucket"))
            .where(F.col("bucket").isNotNull())
            .groupBy("bucket").agg(F.count(F.lit(1)).alias("cnt")))


def bucket_totals() -> list[Column]:
    """AGG2 / AGG3 as aggregate columns over sessions, for ``agg`` or ``observe``: the number of
    sessions, and of those in each visit-length (``v_``) and step-length (``s_``) bucket."""
    return ([F.count(F.lit(1)).alias("session_count")]
            + [F.count_if(visit_bucket("visit_length") == name).alias(f"v_{name}") for name in VISIT_BUCKETS]
            + [F.count_if(step_bucket("step_length") == name).alias(f"s_{name}") for name in STEP_BUCKETS])


def stats_of_totals(totals: DataFrame) -> DataFrame:
    """AGG3 from a row of ``bucket_totals``."""
    out = [F.col("session_count").cast("bigint").alias("session_count")]
    for name in VISIT_BUCKETS:
        out.append(half_up_ratio(f"`v_{name}`", "session_count").alias(f"visit_length_{name}_ratio"))
    for name in STEP_BUCKETS:
        out.append(half_up_ratio(f"`s_{name}`", "session_count").alias(f"step_length_{name}_ratio"))
    return totals.select(*out)


def counts_of_totals(totals: DataFrame) -> DataFrame:
    """AGG2 from a row of ``bucket_totals``: a row for each bucket that has sessions."""
    pairs = [F.struct(F.lit(label).alias("bucket"), F.col(f"`{name}`").cast("bigint").alias("cnt"))
             for name, label in [("session_count", "session_count"), *[(f"v_{n}", n) for n in VISIT_BUCKETS], *[(f"s_{n}", n) for n in STEP_BUCKETS]]]
    return totals.select(F.inline(F.array(*pairs))).where("cnt > 0")


def session_stats(sessions: DataFrame) -> DataFrame:
    """AGG3: one row, ``session_count`` and the 15 bucket ratios (HALF_UP, 2 digits).

    A single global aggregate of conditional counts: partial per task, one
    tiny final merge.  Ratios are null for an empty input."""
    return stats_of_totals(sessions.agg(*bucket_totals()))


def actions_of_sessions(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """JON2: the actions of the given sessions (left semi join on session_id)."""
    return actions.join(sessions.select("session_id"), "session_id", "left_semi")


STAT_COLUMNS = (["session_count"] + [f"visit_length_{n}_ratio" for n in VISIT_BUCKETS]
                + [f"step_length_{n}_ratio" for n in STEP_BUCKETS])
