"""Incremental stream tables: what a batch reads, what a compaction rewrites, late clicks,
bounded state, and batches that are replayed."""

import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickscope.operators import ads as AD
from clickscope.operators.batch_log import BatchLog
from clickscope.sources.fixtures import Fixture
from clickscope.streaming import ads_stream as ST
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
T0 = 1704067200000
DAY = 86_400_000
SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("n", T.LongType()), T.StructField("date", T.StringType()),
                       T.StructField("bucket", T.IntegerType())])


def _lines(spark, folder, lines, start_id=0):
    spark.createDataFrame([(start_id + i, v) for i, v in enumerate(lines)], "event_id bigint, value string") \
         .coalesce(1).write.mode("append").parquet(folder)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _folders(df) -> set:
    """Folders that a plan reads, below the table's root."""
    names = {r[0] for r in df.select(F.input_file_name()).distinct().collect()}
    return {re.search(r"((_compact/upto|batch_id)=.*)/[^/]*$", n)[1] for n in names}


# --- partitioned logs -----------------------------------------------------------

def _log(spark, root, mode="sum", every=2):
    return BatchLog(spark, root, ["date", "bucket", "k"], mode, SCHEMA, ["date", "bucket"], every)


def _rows(spark, *r):
    return spark.createDataFrame(r, SCHEMA)


def test_compaction_rewrites_only_days_with_new_rows(spark, scratch):
    log = _log(spark, scratch)
    log.publish(_rows(spark, (1, 5, "20240101", 0), (2, 1, "20240102", 1)), 0)
    log.publish(_rows(spark, (1, 2, "20240101", 0)), 1)
    log.publish(_rows(spark, (1, 1, "20240103", 0)), 2)   # compacts 0 and 1 first
    log.publish(_rows(spark), 3)
    log.publish(_rows(spark, (3, 7, "20240103", 1)), 4)   # compacts 2 and 3: day 3 alone
    days = {d: sorted(os.listdir(os.path.join(scratch, "_compact", d))) for d in sorted(os.listdir(os.path.join(scratch, "_compact")))}
    assert {d: [x for x in v if x.startswith("date")] for d, v in days.items()} == {
        "upto=2": ["date=20240101", "date=20240102"], "upto=4": ["date=20240103"]}
    want = [(1, 1, "20240103", 0), (1, 7, "20240101", 0), (2, 1, "20240102", 1), (3, 7, "20240103", 1)]
    assert rows(log.view()) == want
    assert rows(log.view(before=2)) == [(1, 7, "20240101", 0), (2, 1, "20240102", 1)]
    assert rows(log.view(before=1)) == [(1, 5, "20240101", 0), (2, 1, "20240102", 1)]
    assert rows(log.view(values=["20240103"], condition=F.col("bucket").isin([1]))) == [(3, 7, "20240103", 1)]
    assert log.days() == ["20240101", "20240102", "20240103"]


def test_lookup_reads_the_asked_folders_only(spark, scratch):
    log = _log(spark, scratch, every=3)
    for b in range(5):
        log.publish(_rows(spark, *[(k, 1, f"2024010{1 + k % 3}", k % 4) for k in range(24)]), b)
    keys = _rows(spark, (4, 0, "20240102", 0), (99, 0, "20240102", 0)).select("date", "bucket", "k")
    got = log.lookup(keys, None, ["20240102"], F.col("bucket").isin([0]))
    assert rows(got) == [(4, 5, "20240102", 0)]
    assert all("date=20240102/" in f for f in got.inputFiles())
    folders = _folders(log._parts(None, ["20240102"], F.col("bucket").isin([0])))
    assert folders == {f"{p}/date=20240102/bucket=0" for p in ("_compact/upto=3", "batch_id=3", "batch_id=4")}
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", _plan(got))


@pytest.mark.parametrize("mode", ["latest", "group", "first"])
def test_modes_over_a_compaction(spark, scratch, mode):
    keys = ["date", "bucket"] if mode == "group" else ["date", "bucket", "k"]
    log = BatchLog(spark, scratch, keys, mode, SCHEMA, ["date", "bucket"], 2)
    for b in range(5):
        log.publish(_rows(spark, (1, b if mode != "first" else 7, "20240101", 0), (b, 9, "20240102", 1)), b)
    got = rows(log.view())
    if mode == "latest":
        assert got == [(0, 9, "20240102", 1), (1, 4, "20240101", 0), (1, 9, "20240102", 1), (2, 9, "20240102", 1), (3, 9, "20240102", 1),
                       (4, 9, "20240102", 1)]
    elif mode == "group":
        assert got == [(1, 4, "20240101", 0), (4, 9, "20240102", 1)]
    else:
        assert len(got) == 6 and (1, 7, "20240101", 0) in got


def test_log_without_partitions_and_old_folders(spark, scratch, monkeypatch):
    from clickscope.operators import batch_log
    schema = T.StructType([T.StructField("k", T.LongType())])
    log = BatchLog(spark, scratch, ["k"], "first", schema, (), 2)
    monkeypatch.setattr(batch_log, "KEEP_MS", -1)
    for b in range(6):
        log.publish(spark.createDataFrame([(b % 3,)], schema), b)
    assert rows(log.view()) == [(0,), (1,), (2,)]
    # a compaction that is old enough has taken the place of its batches
    assert sorted(x for x in os.listdir(scratch) if x.startswith("batch_id")) == ["batch_id=4", "batch_id=5"]


# --- blacklist --------------------------------------------------------------------

def _brute_blacklist(batches, threshold):
    """Clicks that stay and users listed, batch after batch."""
    counts, black, clean = {}, set(), []
    for lines in batches:
        seen = set(black)
        for line in lines:
            ts, _, _, user, ad = line.split(" ")
            if int(user) not in seen:
                key = (int(ts) // DAY, user, ad)
                counts[key] = counts.get(key, 0) + 1
                clean.append(line)
                if counts[key] > threshold:
                    black.add(int(user))
    return black, clean


def test_blacklist_out_of_order_with_restart(spark, scratch):
    """Four batches of mixed days, a restart after each, compaction every two."""
    import random
    rng = random.Random(3)
    batches = [[f"{T0 + rng.randrange(4) * DAY + rng.randrange(DAY)} p{rng.randrange(2)} c0 {rng.randrange(30)} {rng.randrange(2)}"
                for _ in range(60)] for _ in range(4)]
    src, root = os.path.join(scratch, "in"), os.path.join(scratch, "a")
    for i, b in enumerate(batches):
        _lines(spark, src, b, 100 * i)
        ST.start_blacklist_stage(ST.line_files(spark, src), root, 2, os.path.join(scratch, "ck"), compact_every=2)
    black, clean = _brute_blacklist(batches, 2)
    assert {r[0] for r in rows(ST.blacklist_table(spark, root, 2))} == black and black
    assert spark.read.parquet(f"{root}/clean").count() == len(clean)
    # a threshold that no run had comes from the counts
    per_key = ST._counts_log(spark, root).view().where("click_count > 1").select("userid").distinct()
    assert rows(ST.blacklist_table(spark, root, 1)) == rows(per_key)


def test_new_threshold_takes_the_stored_counts(spark, scratch):
    src, root, ck = os.path.join(scratch, "in"), os.path.join(scratch, "a"), os.path.join(scratch, "ck")
    _lines(spark, src, [f"{T0} p c 7 1"] * 3 + [f"{T0} p c 8 1"])
    ST.start_blacklist_stage(ST.line_files(spark, src), root, 100, ck)
    _lines(spark, src, [f"{T0} p c 7 1", f"{T0} p c 8 1"], 10)
    ST.start_blacklist_stage(ST.line_files(spark, src), root, 2, ck)
    assert rows(ST.blacklist_table(spark, root, 2)) == [(7,)]
    assert rows(spark.read.parquet(f"{root}/clean"), "batch_id", "userid")[-1] == (1, 8)


def test_a_batch_reads_its_own_days_and_buckets(spark, scratch):
    root = os.path.join(scratch, "a")
    log = ST._counts_log(spark, root)
    click = "event_id bigint, userid bigint, adid bigint, date string"
    for b in range(3):
        r = spark.createDataFrame([(i, i, 1, f"2024010{1 + i % 3}") for i in range(200)], click).withColumn("bucket", ST.user_bucket())
        log.publish(r.groupBy("date", "userid", "adid", "bucket").agg(F.count("*").alias("click_count")), b)
    keys = spark.createDataFrame([(0, 5, 1, "20240103")], click).withColumn("bucket", ST.user_bucket())
    got = ST.stored_counts(log, keys)
    bucket = keys.first()["bucket"]
    assert rows(got, "userid", "click_count") == [(5, 3)]
    assert got.inputFiles() and all("date=20240103/" in f for f in got.inputFiles())
    assert re.search(rf"PartitionFilters: \[[^\]]*bucket#\d+ = {bucket}\)", _plan(got)), _plan(got)


# --- running totals and top-n -----------------------------------------------------

def test_top_from_old_top_and_changes_equals_all_totals(spark, scratch):
    fx = Fixture(spark, SF)
    src, root, ck = (os.path.join(scratch, n) for n in ("src", "b", "ck"))
    log = fx.ad_log()
    clicks = AD.parse_log_lines(log).where("valid")
    for k in range(4):
        part = F.col("event_id") % 4 <= k
        log.where(F.col("event_id") % 4 == k).coalesce(1).write.mode("append").parquet(src)
        ST.start_city_running(ST.parsed_clicks(ST.line_files(spark, src)), root, ck, top_n=2, compact_every=2)
        want = AD.province_top(AD.province_counts(AD.city_counts(clicks.where(part))), 2)
        assert rows(ST.province_top_table(spark, root, 2)) == rows(want)
    assert rows(ST.city_running_table(spark, root)) == rows(AD.city_counts(clicks))
    assert "statestore" in _plan(ST.city_running_table(spark, root)).lower() or "BatchScan" in _plan(ST.city_running_table(spark, root))
    # another n starts from the totals that are there
    _lines(spark, src, [f"{T0} p0 c0 1 1"], 10**6)
    ST.start_city_running(ST.parsed_clicks(ST.line_files(spark, src)), root, ck, top_n=4)
    more = clicks.select("ts_ms", "province", "city", "userid", "adid", "ts").unionByName(
        AD.parse_log_lines(spark.createDataFrame([(f"{T0} p0 c0 1 1",)], "value string")).select("ts_ms", "province", "city", "userid", "adid", "ts"))
    assert rows(ST.province_top_table(spark, root, 4)) == rows(AD.province_top(AD.province_counts(AD.city_counts(more)), 4))


def test_top_refresh_reads_touched_days_of_the_top_table_only(spark, scratch):
    tops = ST._top_log(spark, scratch, 3)
    for b in range(3):
        tops.publish(spark.createDataFrame([(f"2024010{b + 1}", "p", a, 10 - a) for a in range(3)], ST.TOP_SCHEMA), b)
    old = tops.view(3, ["20240102"])
    assert old.inputFiles() and all("date=20240102" in f for f in old.inputFiles())
    changed = spark.createDataFrame([("20240102", "p", 9, 9), ("20240102", "p", 2, 8)], ST.TOP_SCHEMA)
    assert rows(ST.refreshed_top(old, changed, 3), "adid", "click_count") == [(0, 10), (1, 9), (9, 9)]


def test_watermark_table_comes_from_the_log(spark, scratch):
    src, root = os.path.join(scratch, "src"), os.path.join(scratch, "b")
    for i, t in enumerate([T0, T0 + 5 * DAY, T0 + 5 * DAY + 1000, T0 + 9 * DAY]):
        _lines(spark, src, [f"{t} p c 1 1"], i)
    clicks = ST.parsed_clicks(ST.line_files(spark, src, 1))
    ST.start_city_running(clicks, root, os.path.join(scratch, "ck"), watermark="1 day")
    assert rows(ST.city_running_table(spark, root), "date", "click_count") == [("20240101", 1), ("20240106", 2), ("20240110", 1)]


# --- late clicks --------------------------------------------------------------------

def _minutes(spark, lines):
    return AD.minute_trend(AD.parse_log_lines(spark.createDataFrame([(v,) for v in lines], "value string")).where("valid"))


def test_late_clicks_are_kept_and_state_is_bounded(spark, scratch):
    src, root, ck = (os.path.join(scratch, n) for n in ("src", "t", "ck"))
    batches = [
        [f"{T0 + 10 * DAY + k * 60_000} p c 1 1" for k in range(0, 600, 7)],
        [f"{T0 + 2 * DAY + k * 60_000} p c 1 1" for k in range(0, 300, 11)] + [f"{T0 + 12 * DAY} p c 1 2"],   # eight days late and more
        [f"{T0 + 2 * DAY} p c 1 1", f"{T0 + 12 * DAY + 30_000} p c 1 2", f"{T0 + 10 * DAY} p c 1 1"],
        [f"{T0 + 13 * DAY} p c 3 3"],
    ]
    for i, b in enumerate(batches):
        _lines(spark, src, b, 1000 * i)
        ST.start_trend_with_late(ST.parsed_clicks(ST.line_files(spark, src)), root, ck, "1 hour", compact_every=2)
        so_far = [x for c in batches[:i + 1] for x in c]
        want = _minutes(spark, so_far)
        assert rows(ST.minute_trend_table(spark, root)) == rows(want)
        hours = want.groupBy("date", "hour", "adid").agg(F.sum("click_count").alias("click_count"))
        assert rows(ST.hour_trend_table(spark, root)) == rows(hours)
        assert rows(ST.sliding_hour_table(spark, root)) == rows(AD.sliding_hour(AD.parse_log_lines(
            spark.createDataFrame([(v,) for v in so_far], "value string")).where("valid")))
    late = ST._late_log(spark, root).view().groupBy().sum("click_count").first()[0]
    assert late == len(batches[1]) - 1 + 2
    # closed minutes have left the state
    assert spark.read.format("statestore").load(f"{ck}/minute").count() <= 3


def test_followers_of_the_split_drop_nothing(spark, scratch):
    """Several split batches in one of the followers' batches."""
    src, root = os.path.join(scratch, "src"), os.path.join(scratch, "t")
    lines = []
    for i in range(5):
        b = [f"{T0 + (i % 3) * DAY + k * 7_200_000} p c 1 {k % 2}" for k in range(12)]
        lines += b
        _lines(spark, src, b, 100 * i)
    qs = ST.start_trend_with_late(ST.parsed_clicks(ST.line_files(spark, src, 1)), root, os.path.join(scratch, "ck"), "2 hours")
    for q in qs[1:]:
        for p in q.recentProgress:
            assert all(s.numRowsDroppedByWatermark == 0 for s in p.stateOperators)
    assert rows(ST.minute_trend_table(spark, root)) == rows(_minutes(spark, lines))
