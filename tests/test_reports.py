import os

from clickscope.params import FIXTURE_PARAMS
from clickscope.plans import reports as RP
from clickscope.plans.registry import QUERIES
from clickscope.sources.fixtures import Fixture
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def test_session_report_to_parquet(spark, scratch):
    fx = Fixture(spark, SF)
    out = os.path.join(scratch, "out")
    tid = RP.run_session_report(spark, fx.visit_log(), fx.users(), FIXTURE_PARAMS, RP.parquet_writer(out), "t1")
    assert tid == "t1"
    stats = spark.read.parquet(f"{out}/session_aggr_stat")
    assert stats.first()["session_count"] == 88 and stats.first()["taskid"] == "t1"
    top = spark.read.parquet(f"{out}/top10_category").drop("taskid")
    assert rows(top) == rows(QUERIES["top_categories"](spark, SF))
    sample = spark.read.parquet(f"{out}/session_random_extract").drop("taskid")
    assert rows(sample) == rows(QUERIES["session_sample"](spark, SF))
    ts = spark.read.parquet(f"{out}/top10_session").drop("taskid")
    assert rows(ts) == rows(QUERIES["top_sessions_per_category"](spark, SF))
    assert spark.read.parquet(f"{out}/session_detail").count() == QUERIES["session_sample_detail"](spark, SF).count()


def test_funnel_and_area_to_jdbc(spark):
    fx = Fixture(spark, SF)
    url = "jdbc:derby:memory:clickscope_reports;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    w = RP.jdbc_writer(url, props)
    RP.run_page_conversion(spark, fx.visit_log(), FIXTURE_PARAMS, w, "t2")
    RP.run_area_top3(spark, fx.visit_log(), fx.products(), fx.cities(), FIXTURE_PARAMS, w, "t2")
    back = spark.read.jdbc(url, "page_split_convert_rate", properties=props)
    assert back.count() == 6
    area = spark.read.jdbc(url, "area_top3_product", properties=props)
    assert area.count() == QUERIES["area_top3"](spark, SF).count()


def test_cli_commands(spark, scratch):
    from clickscope import cli

    fx = Fixture(spark, SF)
    root = fx.root()
    out = os.path.join(scratch, "cli")
    params = '{"startDate": "2024-01-01", "endDate": "2024-01-31", "startAge": "20", "endAge": "50", ' \
             '"targetPageFlow": "1,2,3,4,5,6,7"}'
    tid = cli.main(["session-report", "--visit-log", f"{root}/visit_log", "--users", f"{root}/users",
                    "--params", params, "--out", out, "--task-id", "c1"], spark=spark)
    assert tid == "c1"
    assert spark.read.parquet(f"{out}/session_aggr_stat").first()["session_count"] == 88
    cli.main(["page-conversion", "--visit-log", f"{root}/visit_log", "--params", params, "--out", out], spark=spark)
    assert spark.read.parquet(f"{out}/page_split_convert_rate").count() == 6
    cli.main(["page-conversion", "--visit-log", f"{root}/visit_log", "--params", params, "--out", f"{out}-raw", "--raw-rate"], spark=spark)
    raw = [r.rate for r in spark.read.parquet(f"{out}-raw/page_split_convert_rate").collect() if r.rate is not None]
    assert any(abs(100 * r - round(100 * r)) > 1e-6 for r in raw)
    cli.main(["session-report", "--visit-log", f"{root}/visit_log", "--users", f"{root}/users", "--params", params,
              "--out", f"{out}-top", "--top-categories", "4"], spark=spark)
    assert spark.read.parquet(f"{out}-top/top10_category").count() == 4
    cli.main(["area-top3", "--visit-log", f"{root}/visit_log", "--products", f"{root}/products", "--out", out],
             spark=spark)
    assert spark.read.parquet(f"{out}/area_top3_product").count() > 0
    sroot = cli.main(["ads-stream", "--lines", fx.ad_log_path(), "--out", os.path.join(scratch, "ads"),
                      "--trigger", "once", "--threshold", "2"], spark=spark)
    from clickscope.streaming import ads_stream as ST
    assert ST.city_running_table(spark, sroot).count() > 0
