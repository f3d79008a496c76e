"""Category counts and rankings (AGG4-AGG7, SET1, JON3, JON6, TOP1, TOP3/WIN3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickscope.functions.exprs import csv_to_longs

CATEGORY_COUNT_COLUMNS = ["category_id", "click_count", "order_count", "pay_count"]


def _exploded(actions: DataFrame, column: str) -> DataFrame:
    return (actions.where(F.col(column).isNotNull())
            .select(F.explode(csv_to_longs(column)).alias("category_id")))


def category_clicks(actions: DataFrame) -> DataFrame:
    """AGG4: clicks per category."""
    return (actions.where(F.col("click_category_id") != -1)
            .groupBy(F.col("click_category_id").alias("category_id"))
            .agg(F.count(F.lit(1)).alias("cnt")))


def category_orders(actions: DataFrame) -> DataFrame:
    """AGG5: orders per category (csv ids exploded; a repeated id counts twice)."""
    return _exploded(actions, "order_category_ids").groupBy("category_id").agg(F.count(F.lit(1)).alias("cnt"))


def category_pays(actions: DataFrame) -> DataFrame:
    """AGG6: payments per category."""
    return _exploded(actions, "pay_category_ids").groupBy("category_id").agg(F.count(F.lit(1)).alias("cnt"))


def _kinds(actions: DataFrame, *keep: str) -> DataFrame:
    """One ``(category_id, kind)`` row per click, ordered id and paid id, and the columns ``keep``.

    A single narrow pass: the three sources become one exploded array per
    action, so the counts below need one shuffle instead of three joins."""
    click = F.when(F.col("click_category_id") != -1,
                   F.array(F.struct(F.col("click_category_id").alias("c"), F.lit(0).alias("k"))))
    orders = F.transform(csv_to_longs("order_category_ids"), lambda x: F.struct(x.alias("c"), F.lit(1).alias("k")))
    pays = F.transform(csv_to_longs("pay_category_ids"), lambda x: F.struct(x.alias("c"), F.lit(2).alias("k")))
    empty = F.array().cast("array<struct<c:bigint,k:int>>")
    allk = F.concat(F.coalesce(click, empty), F.coalesce(orders, empty), F.coalesce(pays, empty))
    return actions.select(*keep, F.inline(allk)).select(*keep, F.col("c").alias("category_id"), F.col("k").alias("kind"))


def _kind_counts() -> list:
    return [F.count_if(F.col("kind") == k).cast("bigint").alias(f"{name}_count") for k, name in enumerate(("click", "order", "pay"))]


def category_universe(actions: DataFrame) -> DataFrame:
    """SET1: every category that was clicked, ordered or paid (distinct)."""
    return _kinds(actions).select("category_id").distinct()


def category_counts(actions: DataFrame) -> DataFrame:
    """JON3: click / order / pay counts for every category of the universe,
    0 where a kind is missing (the left-outer joins of the original, as one
    partial + final aggregate)."""
    return _kinds(actions).groupBy("category_id").agg(*_kind_counts())


def category_session_counts(actions: DataFrame) -> DataFrame:
    """JON3 and AGG7 in one pass: ``level`` 1 has the counts of each category, ``level`` 0 those
    of each (category, session).  One expanded table, one aggregate, one exchange; written once
    (``SessionReport.written``) it serves TOP1 and TOP3."""
    rows = _kinds(actions, "session_id")
    key, session = F.col("category_id"), F.col("session_id")
    return (rows.groupingSets([[key], [key, session]], key, session)
            .agg(*_kind_counts(), F.grouping("session_id").cast("int").alias("level")))


def top_categories(actions: DataFrame, n: int = 10) -> DataFrame:
    """TOP1/TOP2: the ``n`` categories with most clicks, then orders, then pays;
    ties by category id.  Planned as ``TakeOrderedAndProject`` (per-task top-n,
    one small merge)."""
    return first_categories(category_counts(actions), n)


def first_categories(counts: DataFrame, n: int = 10) -> DataFrame:
    """TOP1/TOP2 from category counts."""
    return (counts.select(*CATEGORY_COUNT_COLUMNS)
            .orderBy(F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), F.asc("category_id"))
            .limit(n))


def session_category_clicks(actions: DataFrame, categories: DataFrame | None = None) -> DataFrame:
    """AGG7 (+JON6): clicks per (category, session), optionally restricted to the
    given categories (a bounded top-n list, so it is broadcast)."""
    clicks = actions.where(F.col("click_category_id") != -1)
    if categories is not None:
        keep = F.broadcast(categories.select(F.col("category_id").alias("click_category_id")))
        clicks = clicks.join(keep, "click_category_id", "left_semi")
    return (clicks.groupBy(F.col("click_category_id").alias("category_id"), "session_id")
            .agg(F.count(F.lit(1)).alias("click_count")))


def top_sessions_per_category(actions: DataFrame, top_n_categories: int = 10, n: int = 10) -> DataFrame:
    """TOP3/WIN3: for each of the top categories, its ``n`` sessions with most
    clicks (ties by session id).  ``row_number() <= n`` with a literal ``n`` is
    planned as a WindowGroupLimit, which also trims each map task's rows
    before the shuffle, so a hot category never sends more than ``n`` rows per
    task to its window."""
    top = top_categories(actions, top_n_categories).select("category_id")
    return first_sessions(session_category_clicks(actions, top), n)


def category_session_clicks(counts: DataFrame, top_n_categories: int) -> DataFrame:
    """JON6 + AGG7 from ``category_session_counts``: clicks per session of the top categories."""
    top = F.broadcast(first_categories(counts.where("level = 1"), top_n_categories).select("category_id"))
    return (counts.where("level = 0 and click_count > 0").join(top, "category_id", "left_semi")
            .select("category_id", "session_id", "click_count"))


def first_sessions(counts: DataFrame, n: int = 10) -> DataFrame:
    """WIN3 from clicks per (category, session)."""
    w = Window.partitionBy("category_id").orderBy(F.desc("click_count"), F.asc("session_id"))
    return (counts.withColumn("rn", F.row_number().over(w))
            .where(F.col("rn") <= n).drop("rn"))
