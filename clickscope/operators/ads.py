"""Ad-click transforms shared by the batch form and the stream
(ST1, AGG13, AGG14, WIN2, SET2, FLT8, FLT9, ST3, ST5).

Every function here is a plain DataFrame transform, so the same code runs
on a static table, inside ``foreachBatch`` or on a streaming DataFrame
(where Spark allows the operator on streams)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY_USER = ["date", "userid", "adid"]
KEY_CITY = ["date", "province", "city", "adid"]
KEY_PROVINCE = ["date", "province", "adid"]
PROVINCE_GROUP = ["date", "province"]


def parse_log_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """ST1 / FN17: split ``ts_ms province city userid adid``.

    Adds ``ts_ms, province, city, userid, adid``, the event time ``ts`` and
    ``valid`` (false for lines not of that form; their fields are null).
    A line is valid with five fields or more (further ones and a trailing blank
    are passed over), any bigint as its numbers and no empty province or city.
    Other columns of ``lines`` are kept."""
    parts = F.split(F.col(value), " ")
    at = [F.get(parts, F.lit(k)) for k in range(5)]
    ts, user, ad = (at[k].try_cast("bigint") for k in (0, 3, 4))
    ok = F.coalesce(ts.isNotNull() & user.isNotNull() & ad.isNotNull() & (at[1] != "") & (at[2] != ""), F.lit(False))
    return lines.select(
        "*",
        F.when(ok, ts).alias("ts_ms"),
        F.when(ok, at[1]).alias("province"),
        F.when(ok, at[2]).alias("city"),
        F.when(ok, user).alias("userid"),
        F.when(ok, ad).alias("adid"),
        ok.alias("valid"),
    ).withColumn("ts", F.timestamp_millis(F.col("ts_ms")))


def with_date(clicks: DataFrame) -> DataFrame:
    """Event day ``yyyyMMdd`` (FN5 ``formatDateKey``) from the click time."""
    ts = F.col("ts") if "ts" in clicks.columns else F.timestamp_millis(F.col("ts_ms"))
    return clicks.withColumn("date", F.date_format(ts, "yyyyMMdd"))


def user_ad_counts(clicks: DataFrame) -> DataFrame:
    """AGG13: clicks per (date, user, ad)."""
    return with_date(clicks).groupBy(*KEY_USER).agg(F.count(F.lit(1)).alias("click_count"))


def blacklist_from_counts(counts: DataFrame, threshold: int) -> DataFrame:
    """FLT9 + SET2: users with some (date, ad) count above ``threshold``."""
    return counts.where(F.col("click_count") > threshold).select("userid").distinct()


def exclude_blacklisted(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """FLT8: drop clicks of blacklisted users (left anti join; the planner
    broadcasts the blacklist only when its measured size allows)."""
    return clicks.join(blacklist.select("userid"), "userid", "left_anti")


def city_counts(clicks: DataFrame) -> DataFrame:
    """ST3 (batch form): clicks per (date, province, city, ad)."""
    return with_date(clicks).groupBy(*KEY_CITY).agg(F.count(F.lit(1)).alias("click_count"))


def province_counts(city: DataFrame) -> DataFrame:
    """AGG14: roll city counts up to (date, province, ad)."""
    return city.groupBy(*KEY_PROVINCE).agg(F.sum("click_count").cast("bigint").alias("click_count"))


def province_top(province: DataFrame, n: int = 3) -> DataFrame:
    """WIN2: the ``n`` ads with most clicks per (date, province), ties by ad id.
    A WindowGroupLimit: map tasks pre-trim to ``n`` rows per group."""
    w = Window.partitionBy(*PROVINCE_GROUP).orderBy(F.desc("click_count"), F.asc("adid"))
    return (province.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
            .select("date", "province", "adid", "click_count"))


def minute_window(ts: Column) -> Column:
    return F.window(ts, "1 minute")


def minute_trend(clicks: DataFrame) -> DataFrame:
    """ST5a: clicks per (minute, ad) as ``date`` (yyyyMMdd), ``hour``, ``minute``.

    Tumbling 1-minute event-time windows; the same expression runs on a stream."""
    g = clicks.groupBy(minute_window(F.col("ts")).alias("w"), "adid").agg(F.count(F.lit(1)).alias("click_count"))
    start = F.col("w.start")
    return g.select(F.date_format(start, "yyyyMMdd").alias("date"), F.date_format(start, "HH").alias("hour"),
                    F.date_format(start, "mm").alias("minute"), "adid", "click_count")


#: Minutes of one block of the sliding windows of an ad (a day).
BLOCK_MINUTES = 1440


def window_changes(per_minute: DataFrame, window_minutes: int = 60) -> DataFrame:
    """(adid, block, at, change): where the count of the windows that slide over
    per-minute counts ``(m, adid, c)`` changes; ``at`` counts minutes from the epoch.

    A minute's clicks enter at the first window that holds it (+c) and leave after the
    last one (-c): two rows.  Windows are cut into blocks, and a count that goes on into
    the next block enters that again at its start, so each (ad, block) sums by itself."""
    size = max(BLOCK_MINUTES, int(window_minutes))
    m = F.expr("floor(unix_seconds(m) / 60)")
    rows = per_minute.select("adid", "c", (m - int(window_minutes) + 1).alias("enter"), (m + 1).alias("leave"))
    rows = rows.select("adid", "c", "enter", "leave", F.expr(f"floor(enter / {size})").alias("first"), F.expr(f"floor((leave - 1) / {size})").alias("last"))
    one = F.struct(F.col("first").alias("block"), F.col("enter").alias("at"), F.col("c").alias("change"))
    out = F.struct(F.col("last").alias("block"), F.col("leave").alias("at"), (-F.col("c")).alias("change"))
    again = F.struct(F.col("last").alias("block"), (F.col("last") * size).alias("at"), F.col("c").alias("change"))
    return rows.select("adid", F.inline(F.when(F.col("first") == F.col("last"), F.array(one, out)).otherwise(F.array(one, again, out))))


def sliding_from_minutes(per_minute: DataFrame, window_minutes: int = 60) -> DataFrame:
    """ST5b from per-minute counts ``(m, adid, c)``: a running sum of the changes of each
    (ad, block) holds from one change to the next one or the block's end; only then
    are its windows written out, one a minute."""
    size = max(BLOCK_MINUTES, int(window_minutes))
    w = Window.partitionBy("adid", "block").orderBy("at")
    sums = window_changes(per_minute, window_minutes).select(
        "adid", "block", "at", F.sum("change").over(w.rangeBetween(Window.unboundedPreceding, 0)).alias("click_count"),
        F.lead("at").over(w).alias("until"))
    # of the changes at one minute the last one leads to the next minute; a count that the
    # block's end cuts off goes on in the next block
    end = F.least(F.coalesce("until", (F.col("block") + 1) * size), (F.col("block") + 1) * size)
    held = sums.where((F.col("click_count") > 0) & (end > F.col("at"))).select(
        "adid", F.col("click_count").cast("bigint").alias("click_count"), F.explode(F.sequence("at", end - 1)).alias("ws"))
    fmt = "yyyy-MM-dd HH:mm:ss"
    start = F.timestamp_seconds(F.col("ws") * 60)
    return held.select(F.date_format(start, fmt).alias("window_start"),
                       F.date_format(F.timestamp_seconds((F.col("ws") + int(window_minutes)) * 60), fmt).alias("window_end"),
                       "adid", "click_count")


def sliding_hour(clicks: DataFrame, window_minutes: int = 60) -> DataFrame:
    """ST5b: clicks per (60-minute window sliding by 1 minute, ad).

    First a per-(minute, ad) count (map-side combined); each then sends the two changes
    that it brings to the windows (``window_changes``), not a row for every window."""
    per_min = clicks.groupBy(F.date_trunc("minute", F.col("ts")).alias("m"), "adid") \
                    .agg(F.count(F.lit(1)).alias("c"))
    return sliding_from_minutes(per_min, window_minutes)
