"""Structured Streaming jobs: the stream's final tables equal the batch
operators, restarts resume from the checkpoint, replays add nothing, late
rows are dropped and the blacklist feeds back into the next batch."""

import os

from pyspark.sql import functions as F

from clickscope.operators import ads as AD
from clickscope.sources.fixtures import Fixture
from clickscope.streaming import ads_stream as ST
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
T0 = 1704067200000


def _write_chunks(spark, lines, folder, n):
    """Write the log lines as ``n`` files in event order, one file per write
    so modification times follow the order."""
    lo, hi = lines.agg(F.min("event_id"), F.max("event_id")).first()
    step = (hi - lo) // n + 1
    for i in range(n):
        part = lines.where((F.col("event_id") >= lo + i * step) & (F.col("event_id") < lo + (i + 1) * step))
        part.coalesce(1).write.mode("append").parquet(folder)


def _lit_lines(spark, lines, start_id=0):
    return spark.createDataFrame([(start_id + i, v) for i, v in enumerate(lines)], "event_id bigint, value string")


def test_job_equals_batch_over_many_files(spark, scratch):
    fx = Fixture(spark, SF)
    src = os.path.join(scratch, "src")
    _write_chunks(spark, fx.ad_log(), src, 4)
    root = os.path.join(scratch, "job")
    lines = ST.line_files(spark, src, max_files_per_trigger=1)
    ST.run_ads_job(spark, lines, threshold=10**9, top_n=3, root=root)
    clicks = AD.parse_log_lines(fx.ad_log()).where("valid")
    assert rows(ST.city_running_table(spark, root)) == rows(AD.city_counts(clicks))
    assert rows(ST.province_top_table(spark, root)) == rows(AD.province_top(AD.province_counts(AD.city_counts(clicks)), 3))
    assert rows(ST.minute_trend_table(spark, root)) == rows(AD.minute_trend(clicks))
    assert rows(ST.sliding_hour_table(spark, root)) == rows(AD.sliding_hour(clicks))
    # four micro-batches were published
    batches = {r.batch_id for r in spark.read.parquet(f"{root}/clean").select("batch_id").distinct().collect()}
    assert batches == {0, 1, 2, 3}
    assert ST.blacklist_table(spark, root, 10**9).count() == 0


def test_restart_from_checkpoint(spark, scratch):
    fx = Fixture(spark, SF)
    lines = fx.ad_log()
    src = os.path.join(scratch, "src")
    lo, hi = lines.agg(F.min("event_id"), F.max("event_id")).first()
    mid = (lo + hi) // 2
    lines.where(F.col("event_id") <= mid).coalesce(1).write.mode("append").parquet(src)
    root, ck = os.path.join(scratch, "out"), os.path.join(scratch, "ck")
    ST.start_city_running(ST.parsed_clicks(ST.line_files(spark, src)), root, ck)
    first = ST.city_running_table(spark, root).count()
    lines.where(F.col("event_id") > mid).coalesce(1).write.mode("append").parquet(src)
    # same checkpoint: the first file is not read again, state continues
    ST.start_city_running(ST.parsed_clicks(ST.line_files(spark, src)), root, ck)
    clicks = AD.parse_log_lines(lines).where("valid")
    assert first > 0
    assert rows(ST.city_running_table(spark, root)) == rows(AD.city_counts(clicks))


def test_late_rows_and_watermark(spark, scratch):
    """Watermark 1 hour.  A late row whose minute is still in the state store
    is counted (the total stays exact); once the watermark has evicted the
    minute, a later row for it is dropped and reported - never a partial
    count overwriting the published one."""
    src = os.path.join(scratch, "src")
    hour = 3600_000
    for i, t in enumerate([T0 + 8 * hour, T0 + 12 * hour, T0 + 8 * hour + 30_000, T0 + 8 * hour + 40_000]):
        _lit_lines(spark, [f"{t} p0 c0 1 1"], 10 * i).coalesce(1).write.mode("append").parquet(src)
    root = os.path.join(scratch, "out")
    clicks = ST.parsed_clicks(ST.line_files(spark, src, max_files_per_trigger=1))
    q = ST.start_minute_trend(clicks, root, os.path.join(scratch, "ck"), watermark="1 hour")
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress if p.get("stateOperators"))
    assert dropped == 1
    assert rows(ST.minute_trend_table(spark, root)) == [("20240101", "08", "00", 1, 2), ("20240101", "12", "00", 1, 1)]


def test_blacklist_feeds_next_batch_and_rejects(spark, scratch):
    src = os.path.join(scratch, "src")
    b0 = [f"{T0} p0 c0 7 1"] * 3 + [f"{T0} p0 c0 8 1", "bad line"]
    b1 = [f"{T0 + 1000} p0 c0 7 1", f"{T0 + 1000} p0 c0 8 1"]
    _lit_lines(spark, b0).coalesce(1).write.mode("append").parquet(src)
    _lit_lines(spark, b1, 100).coalesce(1).write.mode("append").parquet(src)
    root = os.path.join(scratch, "a")
    ST.start_blacklist_stage(ST.line_files(spark, src, max_files_per_trigger=1), root, 2, os.path.join(scratch, "ck"))
    clean = spark.read.parquet(f"{root}/clean")
    # batch 0 is counted in full (the blacklist is empty before it); in batch 1
    # user 7 is already blacklisted and dropped
    assert rows(clean, "batch_id", "userid") == [(0, 7), (0, 7), (0, 7), (0, 8), (1, 8)]
    assert rows(ST.blacklist_table(spark, root, 2)) == [(7,)]
    assert [r.value for r in spark.read.parquet(f"{root}/rejects").collect()] == ["bad line"]


def test_replayed_batch_adds_nothing(spark, scratch):
    """A batch whose output folder exists is skipped: re-running the same
    batch id (as after a failure between write and commit) adds nothing."""
    src = os.path.join(scratch, "src")
    _lit_lines(spark, [f"{T0} p0 c0 7 1"] * 2).coalesce(1).write.mode("append").parquet(src)
    root = os.path.join(scratch, "a")
    ST.start_blacklist_stage(ST.line_files(spark, src), root, 100, os.path.join(scratch, "ck"))
    # a fresh checkpoint replays batch 0 against the same output folders
    ST.start_blacklist_stage(ST.line_files(spark, src), root, 100, os.path.join(scratch, "ck2"))
    totals = spark.read.parquet(f"{root}/user_counts").groupBy().sum("click_count").first()[0]
    assert totals == 2


def test_job_queries_side_by_side(spark, scratch):
    """Stage A and stage B started together; stage B follows stage A's folders."""
    fx = Fixture(spark, SF)
    root = os.path.join(scratch, "job")
    job = ST.run_ads_job(spark, ST.line_files(spark, fx.ad_log_path()), threshold=10**9, root=root,
                         trigger={"processingTime": "1 second"}, await_end=False)
    qa, qb, qc = job["queries"]
    try:
        qa.processAllAvailable()
        qb.processAllAvailable()
        qc.processAllAvailable()
    finally:
        for q in job["queries"]:
            q.stop()
    clicks = AD.parse_log_lines(fx.ad_log()).where("valid")
    assert rows(ST.city_running_table(spark, root)) == rows(AD.city_counts(clicks))


def test_compaction_keeps_blacklist_and_totals(spark, scratch):
    """Batches cut small with compaction every 2 batches: the blacklist seen by
    each batch is the same as without compaction."""
    src = os.path.join(scratch, "src")
    day = 86_400_000
    batches = [
        [f"{T0} p0 c0 7 1"] * 2,                 # b0: user 7 at 2 clicks
        [f"{T0} p0 c0 7 1", f"{T0} p0 c0 8 1"],  # b1: user 7 at 3 -> blacklisted from b2 on
        [f"{T0} p0 c0 7 1", f"{T0 + 3 * day} p0 c0 8 1"],   # b2: user 7 dropped
        [f"{T0 + 3 * day} p0 c0 8 1"] * 2,       # b3: user 8 at 3 on day 4
        [f"{T0 + 3 * day} p0 c0 8 1", f"{T0 + 3 * day} p0 c0 9 2"],  # b4: user 8 dropped
    ]
    for i, b in enumerate(batches):
        _lit_lines(spark, b, 100 * i).coalesce(1).write.mode("append").parquet(src)
    outs = {}
    for every in (0, 2):
        root = os.path.join(scratch, f"a{every}")
        ST.start_blacklist_stage(ST.line_files(spark, src, max_files_per_trigger=1), root, 2,
                                 os.path.join(scratch, f"ck{every}"), compact_every=every, retain_days=1)
        outs[every] = (rows(spark.read.parquet(f"{root}/clean"), "batch_id", "userid"),
                       rows(ST.blacklist_table(spark, root, 2)))
    assert outs[0] == outs[2]
    clean, black = outs[2]
    assert black == [(7,), (8,)]
    assert (2, 7) not in clean and (4, 8) not in clean and (4, 9) in clean
    assert os.path.isdir(os.path.join(scratch, "a2", "user_counts", "_compact", "upto=2"))


def test_stage_b_compaction_matches_batch(spark, scratch):
    """City totals and province top-3 with a compaction every 2 batches."""
    fx = Fixture(spark, SF)
    src = os.path.join(scratch, "src")
    _write_chunks(spark, fx.ad_log(), src, 5)
    root = os.path.join(scratch, "b")
    clicks = ST.parsed_clicks(ST.line_files(spark, src, max_files_per_trigger=1))
    ST.start_city_running(clicks, root, os.path.join(scratch, "ck"), compact_every=2)
    parsed = AD.parse_log_lines(fx.ad_log()).where("valid")
    assert rows(ST.city_running_table(spark, root)) == rows(AD.city_counts(parsed))
    want_top = rows(AD.province_top(AD.province_counts(AD.city_counts(parsed)), 3))
    assert rows(ST.province_top_table(spark, root)) == want_top
    assert os.path.isdir(os.path.join(root, "city_running", "_compact", "upto=4"))


def test_events_folder_source(spark, scratch):
    """The stream derives log lines from a folder of raw event files."""
    src = os.path.join(scratch, "events")
    spark.read.parquet(f"{SF}/events.parquet").coalesce(1).write.parquet(src)
    out = os.path.join(scratch, "parsed")
    ST.start_parse_to_files(ST.event_file_lines(spark, src), out, os.path.join(scratch, "ck"))
    got = spark.read.parquet(out)
    assert got.count() == spark.read.parquet(f"{SF}/events.parquet").count()
    assert rows(got.select("event_id", "userid")) == rows(Fixture(spark, SF).ad_log().select(
        "event_id", F.expr("CAST(split(value, ' ')[3] AS BIGINT)").alias("userid")))


def test_rejected_lines_are_written(spark, scratch):
    src, out = os.path.join(scratch, "lines"), os.path.join(scratch, "parsed")
    spark.createDataFrame([(1, "1704067200000 p c 7 8"), (2, "no click"), (3, None)], "event_id long, value string").write.parquet(src)
    ST.start_parse_to_files(ST.line_files(spark, src, 1), out, os.path.join(scratch, "ck"))
    got = {r.event_id: (r.valid, r.userid, r.value) for r in spark.read.parquet(out).collect()}
    assert got == {1: ("true", 7, None), 2: ("false", None, "no click"), 3: ("false", None, None)}
