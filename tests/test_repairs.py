"""Behaviour that must not depend on batch cuts, caps or machine-local folders."""

import pytest
from pyspark.sql import functions as F

from clickscope import session
from clickscope.functions import exprs as X
from clickscope.operators import ads, batch_log, funnel, ordered, sinks
from clickscope.params import TaskParams, params_from_properties
from clickscope.streaming import ads_stream

from .conftest import rows


def one(spark, column, values, schema):
    return [r[0] for r in spark.createDataFrame(values, schema).select(column).collect()]


def test_log_lines_take_any_bigint_and_further_fields(spark):
    lines = ["1704067200000 p c 9223372036854775807 7", "1704067200000 p c 1 7 ", "1704067200000 p c 1 7 more",
             "1704067200000 p c 9223372036854775808 7", "1704067200000 p c 1", "x p c 1 2", "1704067200000  c 1 2", None]
    got = ads.parse_log_lines(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [r.valid for r in got] == [True, True, True, False, False, False, False, False]
    assert got[0].userid == 9223372036854775807 and got[3].userid is None


def test_pad2_json_names_and_delimiters(spark):
    assert one(spark, X.pad2("s"), [("5",), ("12",), ("123",), ("",)], "s string") == ["05", "12", "0123", "0"]
    assert one(spark, X.json_field("s", "a.b"), [('{"a.b":"x","a":{"b":"y"}}',)], "s string") == ["x"]
    assert one(spark, X.kv_get("s", "f", "||"), [("k=1||f=2",)], "s string") == ["2"]
    assert one(spark, X.kv_set("s", "f", "9", "||"), [("k=1||f=2",)], "s string") == ["k=1||f=9"]
    assert one(spark, X.round_half_up("x", 1), [(0.25,), (-0.25,), (2.0,), (1.04,)], "x double") == [0.3, -0.3, 2.0, 1.0]


def test_parameters_keep_quoted_text(spark):
    p = params_from_properties('task.params.json={startAge: 20, "keywords":"a, b:c"}')
    assert p.keywords == "a, b:c" and p.start_age == 20 and TaskParams().sample_size == 100


def test_null_groups_and_null_slices_have_successors(spark):
    times = [None, 0, 1, 2, 3, 4]
    df = spark.createDataFrame([(g, t, k * 10) for g in (None, "a") for k, t in enumerate(times)], "g string, t int, v int")
    want = {(g, k * 10): (k + 1) * 10 if k < 5 else None for g in (None, "a") for k in range(6)}
    for width in (1, 2, 9):
        got = ordered.next_in_group(df, "g", ["t"], "v", slice_by=F.floor(F.col("t") / width))
        assert {(r.g, r.v): r.next_value for r in got.collect()} == want


def test_null_values_and_malformed_times_are_kept_in_order(spark):
    data = [("s", t, i, p) for i, (t, p) in enumerate(
        [("2024-01-01 10:00:01", 1), ("2024-01-01 10:00:59", None), ("2024-01-01 10:01:00", 3), ("bad", 4), ("", 5), (None, 6)])]
    df = spark.createDataFrame(data, "session_id string, action_time string, event_id long, page_id long")
    got = {r.event_id: r.pair for r in funnel.page_transitions(df).where("pair is not null").collect()}
    assert got == {5: "6_5", 4: "5_1", 2: "3_4"}  # null, empty, times, text behind them


def test_latest_per_key_is_a_hash_aggregate(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, None), ("b", 1, 7)], "k string, batch_id int, n long")
    got = sinks.latest_per_key(df, ["k"])
    assert sorted((r.k, r.n) for r in got.collect()) == [("a", None), ("b", 7)]
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()


def test_work_dir_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_dir(Session())


def test_version_published_meanwhile_fails_the_update(spark, scratch):
    t = sinks.VersionedTable(spark, f"{scratch}/t")
    t.update(spark.createDataFrame([(1,)], "x int"), None)

    def merge(current, batch):
        sinks.VersionedTable(spark, f"{scratch}/t").update(spark.createDataFrame([(2,)], "x int"), lambda c, b: c.unionByName(b))
        return current.unionByName(batch)
    with pytest.raises(RuntimeError, match="concurrent"):
        t.update(spark.createDataFrame([(3,)], "x int"), merge)
    assert rows(t.read()) == [(1,), (2,)]


def test_province_top_survives_a_failure_between_the_publishes(spark, scratch, monkeypatch):
    log = [(k, f"{1704067200000 + 60000 * k} p{k % 2} c {k % 5} {k % 4}") for k in range(60)]
    spark.createDataFrame(log, "event_id long, value string").write.parquet(f"{scratch}/in")
    publish = batch_log.publish_batch

    def fails(df, root, batch_id, partition_by=()):
        if "/province_top/" in root:
            raise RuntimeError("lost")
        return publish(df, root, batch_id, partition_by)

    def start():
        clicks = ads_stream.parsed_clicks(ads_stream.line_files(spark, f"{scratch}/in"))
        ads_stream.start_city_running(clicks, f"{scratch}/out", f"{scratch}/ck")
    monkeypatch.setattr(batch_log, "publish_batch", fails)
    with pytest.raises(Exception, match="lost"):
        start()
    monkeypatch.setattr(batch_log, "publish_batch", publish)
    start()
    clicks = ads.parse_log_lines(spark.read.parquet(f"{scratch}/in")).where("valid")
    want = ads.province_top(ads.province_counts(ads.city_counts(clicks)), 3)
    cols = ["date", "province", "adid", "click_count"]
    assert rows(ads_stream.province_top_table(spark, f"{scratch}/out"), *cols) == rows(want, *cols)
