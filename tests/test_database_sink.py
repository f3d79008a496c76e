"""The replay-safe database sink: its statements and transactions, run by DuckDB in this
process in the place of a JDBC database."""

import duckdb
import pytest

from clickscope.operators.database_sink import LEDGER, DuplicateKeyDialect, MergeDialect, TableSink
from clickscope.streaming import ads_stream as ST
from clickscope.operators import ads as AD
from tests.conftest import rows

T0 = 1704067200000


class DuckSink(TableSink):
    """Staging tables and transactions in DuckDB; ``fail`` is asked before each step."""

    def __init__(self, fail=None, **kw):
        super().__init__(**kw)
        self.con = duckdb.connect()
        self.fail = fail or (lambda step: None)
        for name, cols in self.tables().items():
            self.con.execute(f"create table {name} {cols}")

    def stage(self, df, table):
        self.fail(f"stage {table}")
        pdf = df.toPandas()  # noqa: F841  read by the statement below
        types = {"bigint": "bigint", "string": "varchar"}
        self.con.execute(f"create table {table} ({', '.join(f'{self.dialect.cols([n])} {types[t]}' for n, t in df.dtypes)})")
        if len(pdf):
            self.con.execute(f"insert into {table} select * from pdf")

    def unstage(self, table):
        self.con.execute(f"drop table if exists {table}")

    def transaction(self, known, statements):
        self.con.execute("begin")
        try:
            if self.con.execute(known).fetchone()[0]:
                self.con.execute("rollback")
                return False
            for s in statements:
                self.con.execute(s)
                self.fail(s)
            self.fail("commit")
            self.con.execute("commit")
        except Exception:
            self.con.execute("rollback")
            raise
        self.fail("after commit")
        return True

    def table(self, name):
        return sorted(self.con.execute(f"select * from {name}").fetchall())


COUNTS = "date string, userid bigint, adid bigint, click_count bigint"


def _counts(spark, *r):
    return spark.createDataFrame(r, COUNTS)


def test_add_counts_a_replayed_batch_once(spark):
    s = DuckSink()
    keys, values = AD.KEY_USER, ["click_count"]
    assert s.add("ad_user_click_count", _counts(spark, ("d", 1, 1, 5), ("d", 2, 1, 1)), keys, values, 0)
    assert s.add("ad_user_click_count", _counts(spark, ("d", 1, 1, 2), ("d", 3, 1, 4)), keys, values, 1)
    want = [("d", 1, 1, 7), ("d", 2, 1, 1), ("d", 3, 1, 4)]
    assert s.table("ad_user_click_count") == want
    assert not s.add("ad_user_click_count", _counts(spark, ("d", 1, 1, 2), ("d", 3, 1, 4)), keys, values, 1)
    assert s.table("ad_user_click_count") == want
    assert s.table(LEDGER) == [("ad_user_click_count", 0), ("ad_user_click_count", 1)]
    left = {r[0] for r in s.con.execute("select table_name from information_schema.tables").fetchall()}
    assert not any("stage" in t for t in left)


@pytest.mark.parametrize("at", ["stage", "merge", f"insert into {LEDGER}", "commit", "after commit"])
def test_failure_at_any_step_then_replay(spark, at):
    """The batch dies once at the named step; its replay leaves what one run leaves."""
    died = []

    def fail(step):
        if step.startswith(at) and not died:
            died.append(step)
            raise RuntimeError(step)

    s = DuckSink(fail)
    batch = _counts(spark, ("d", 1, 1, 2), ("d", 3, 1, 4))
    s.con.execute("insert into ad_user_click_count values ('d', 1, 1, 10)")
    with pytest.raises(RuntimeError):
        s.add("ad_user_click_count", batch, AD.KEY_USER, ["click_count"], 0)
    assert s.add("ad_user_click_count", batch, AD.KEY_USER, ["click_count"], 0) == (at != "after commit")
    assert s.table("ad_user_click_count") == [("d", 1, 1, 12), ("d", 3, 1, 4)]


def test_replace_group_insert_new_and_append(spark):
    s = DuckSink()
    stat = "date string, province string, city string, adid bigint, click_count bigint"
    s.replace("ad_stat", spark.createDataFrame([("d", "p", "c", 1, 5), ("d", "p", "c", 2, 1)], stat), AD.KEY_CITY, 0)
    s.replace("ad_stat", spark.createDataFrame([("d", "p", "c", 1, 9)], stat), AD.KEY_CITY, 1)
    assert s.table("ad_stat") == [("d", "p", "c", 1, 9), ("d", "p", "c", 2, 1)]
    top = "date string, province string, adid bigint, click_count bigint"
    s.replace_group("ad_province_top3", spark.createDataFrame([("d", "p", 1, 5), ("d", "q", 2, 1)], top), AD.PROVINCE_GROUP, 0)
    s.replace_group("ad_province_top3", spark.createDataFrame([("d", "p", 7, 8)], top), AD.PROVINCE_GROUP, 1)
    assert s.table("ad_province_top3") == [("d", "p", 7, 8), ("d", "q", 2, 1)]
    s.insert_new("ad_blacklist", spark.createDataFrame([(1,), (1,), (2,)], "userid bigint"), ["userid"], 0)
    s.insert_new("ad_blacklist", spark.createDataFrame([(2,), (3,)], "userid bigint"), ["userid"], 1)
    s.insert_new("ad_blacklist", spark.createDataFrame([], "userid bigint"), ["userid"], 2)
    assert s.table("ad_blacklist") == [(1,), (2,), (3,)]
    s.con.execute("create table log (userid bigint)")
    for b in (0, 0, 1):
        s.append("log", spark.createDataFrame([(5,)], "userid bigint"), b)
    assert s.table("log") == [(5,), (5,)]


def test_duplicate_key_statements():
    d = DuplicateKeyDialect()
    assert d.upsert("t1", "s1", ["date", "k"], ["n"], [], ["date", "k", "n"]) == [
        "insert into t1 (`date`, `k`, `n`) select s.`date`, s.`k`, s.`n` from s1 s on duplicate key update `n` = t1.`n` + s.`n`"]
    assert d.upsert("t1", "s1", ["k"], [], ["n"], ["k", "n"])[0].endswith("on duplicate key update `n` = s.`n`")
    assert d.upsert("t1", "s1", ["k"], [], [], ["k"])[0].endswith("on duplicate key update `k` = t1.`k`")
    assert MergeDialect().upsert("t1", "s1", ["k"], [], [], ["k"]) == [
        'merge into t1 t using s1 s on t."k" = s."k" when not matched then insert ("k") values (s."k")']


def _lines(spark, folder, lines, start):
    spark.createDataFrame([(start + i, v) for i, v in enumerate(lines)], "event_id bigint, value string") \
         .coalesce(1).write.mode("append").parquet(folder)


def test_five_tables_of_the_stream_with_a_failed_batch(spark, tmp_path):
    """The job writes its five tables; its second batch dies between two of them and is replayed."""
    import random
    rng = random.Random(7)
    batches = [[f"{T0 + rng.randrange(3) * 86_400_000 + rng.randrange(7_200_000)} p{rng.randrange(2)} c{rng.randrange(3)} {rng.randrange(12)} {rng.randrange(4)}"
                for _ in range(80)] for _ in range(3)]
    died = []

    def fail(step):
        if step.startswith("stage ad_blacklist_stage_1") and not died:
            died.append(step)
            raise RuntimeError(step)

    sink, src, root = DuckSink(fail), str(tmp_path / "in"), str(tmp_path / "job")

    def run():
        ST.run_ads_job(spark, ST.line_files(spark, src), threshold=2, root=root, compact_every=2, buckets=2, sink=sink)

    for i, b in enumerate(batches):
        _lines(spark, src, b, 100 * i)
        if i == 1:
            with pytest.raises(Exception):
                run()
        run()
    assert died
    assert sink.table("ad_user_click_count") == rows(ST._counts_log(spark, root).view(), *AD.KEY_USER, "click_count")
    assert sink.table("ad_blacklist") == rows(ST.blacklist_table(spark, root, 2)) != []
    assert sink.table("ad_stat") == rows(ST.city_running_table(spark, root))
    assert sink.table("ad_province_top3") == rows(ST.province_top_table(spark, root))
    assert sink.table("ad_click_trend") == rows(ST.minute_trend_table(spark, root))
    clean = spark.read.parquet(f"{root}/clean")
    assert rows(ST.city_running_table(spark, root)) == rows(AD.city_counts(clean))
