import os

from clickscope.operators import sinks as SK
from tests.conftest import rows

SCHEMA = "date string, province string, adid bigint, click_count bigint"


def test_upsert_add(spark):
    old = spark.createDataFrame([("d", "p", 1, 5), ("d", "p", 2, 1)], SCHEMA)
    new = spark.createDataFrame([("d", "p", 1, 2), ("d", "q", 3, 4)], SCHEMA)
    got = rows(SK.upsert_add(old, new, ["date", "province", "adid"]))
    assert got == [("d", "p", 1, 7), ("d", "p", 2, 1), ("d", "q", 3, 4)]


def test_upsert_replace(spark):
    old = spark.createDataFrame([("d", "p", 1, 5), ("d", "p", 2, 1)], SCHEMA)
    new = spark.createDataFrame([("d", "p", 1, 2), ("d", "q", 3, 4)], SCHEMA)
    got = rows(SK.upsert_replace(old, new, ["date", "province", "adid"]))
    assert got == [("d", "p", 1, 2), ("d", "p", 2, 1), ("d", "q", 3, 4)]


def test_replace_group(spark):
    old = spark.createDataFrame([("d", "p", 1, 5), ("d", "p", 2, 1), ("d", "r", 9, 9)], SCHEMA)
    new = spark.createDataFrame([("d", "p", 7, 2)], SCHEMA)
    got = rows(SK.replace_group(old, new, ["date", "province"]))
    assert got == [("d", "p", 7, 2), ("d", "r", 9, 9)]


def test_insert_new_and_lookup(spark):
    old = spark.createDataFrame([(1,), (2,)], "userid bigint")
    new = spark.createDataFrame([(2,), (3,), (3,)], "userid bigint")
    assert rows(SK.insert_new(old, new, ["userid"])) == [(3,)]
    counts = spark.createDataFrame([("d", "p", 1, 5)], SCHEMA)
    keys = spark.createDataFrame([("d", "p", 1), ("d", "p", 2)], "date string, province string, adid bigint")
    got = rows(SK.lookup_counts(keys, counts, ["date", "province", "adid"]))
    assert got == [("d", "p", 1, 5), ("d", "p", 2, 0)]


def test_publish_batch_skips_replay(spark, scratch):
    root = os.path.join(scratch, "t")
    df = spark.createDataFrame([("d", "p", 1, 5)], SCHEMA)
    assert SK.publish_batch(df, root, 0) is True
    assert SK.publish_batch(df, root, 0) is False  # replay of batch 0: skipped
    assert SK.publish_batch(df, root, 1) is True
    total = SK.upsert_add(SK.read_batches(spark, root).where("batch_id < 0"), SK.read_batches(spark, root),
                          ["date", "province", "adid"])
    assert rows(total) == [("d", "p", 1, 10)]
    latest = SK.latest_per_key(SK.read_batches(spark, root), ["date", "province", "adid"])
    assert rows(latest) == [("d", "p", 1, 5)]


def test_jdbc_roundtrip_embedded_derby(spark, scratch):
    """SNK1 against an in-memory embedded database (no server)."""
    try:
        spark._jvm.java.lang.Class.forName("org.apache.derby.jdbc.EmbeddedDriver")
    except Exception:  # noqa: BLE001
        import pytest
        pytest.skip("embedded Derby driver not on the classpath")
    url = "jdbc:derby:memory:clickscope_t;create=true"
    df = spark.createDataFrame([("d", "p", 1, 5)], SCHEMA)
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    SK.jdbc_append(df, url, "AD_STAT", props)
    SK.jdbc_append(df, url, "AD_STAT", props)
    back = spark.read.jdbc(url, "AD_STAT", properties=props)
    assert back.count() == 2


def test_save_table(spark, scratch):
    path = os.path.join(scratch, "tbl")
    df = spark.createDataFrame([("d", "p", 1, 5)], SCHEMA)
    SK.save_table(df, path)
    SK.save_table(df, path)
    assert spark.read.parquet(path).count() == 1


def test_versioned_table_updates(spark, scratch):
    keys = ["date", "province", "adid"]
    t = SK.VersionedTable(spark, os.path.join(scratch, "vt"), keep=2, keep_ms=0)
    assert t.read() is None
    t.update(spark.createDataFrame([("d", "p", 1, 5)], SCHEMA), lambda o, b: SK.upsert_add(o, b, keys))
    t.update(spark.createDataFrame([("d", "p", 1, 2), ("d", "p", 2, 1)], SCHEMA),
             lambda o, b: SK.upsert_add(o, b, keys))
    assert rows(t.read()) == [("d", "p", 1, 7), ("d", "p", 2, 1)]
    t.update(spark.createDataFrame([("d", "p", 9, 9)], SCHEMA), lambda o, b: SK.replace_group(o, b, ["date", "province"]))
    assert rows(t.read()) == [("d", "p", 9, 9)]
    assert t.version() == 3
    assert sorted(os.listdir(os.path.join(scratch, "vt"))) == ["_staging", "v=2", "v=3"]
    slow = SK.VersionedTable(spark, os.path.join(scratch, "vt"), keep=1)  # readers may still be at v=3
    slow.update(spark.createDataFrame([("d", "p", 1, 1)], SCHEMA), lambda o, b: SK.upsert_add(o, b, keys))
    assert rows(slow.read(3)) == [("d", "p", 9, 9)]


def test_save_as_catalog_table_and_load(spark):
    from clickscope.plans.jobs import session_report
    from clickscope.params import FIXTURE_PARAMS
    from clickscope.sources.fixtures import Fixture
    from clickscope.sources.tables import load

    fx = Fixture(spark, "/root/testdata/sf0.001")
    SK.save_table(fx.visit_log(), "user_visit_action", as_table=True)
    SK.save_table(fx.visit_log(), "user_visit_action", as_table=True)  # drop-and-save again
    SK.save_table(fx.users(), "user_info", as_table=True)
    acts, users = load(spark, "user_visit_action"), load(spark, "user_info")
    assert acts.count() == 1000
    from clickscope.plans.jobs import SessionReport
    stats = SessionReport(acts, users, FIXTURE_PARAMS).stats().first()
    assert stats["session_count"] == session_report(spark, "/root/testdata/sf0.001", FIXTURE_PARAMS).stats().first()[
        "session_count"]


def test_show_prints_bounded_preview(spark, capsys):
    SK.show(spark.createDataFrame([("d", "p", 1, 5)], SCHEMA), 5)
    assert "click_count" in capsys.readouterr().out
