"""The checked values of FIXTURES.md (computed independently), reproduced by
the registered queries at sf0.001 and sf0.01."""

import pytest
from pyspark.sql import functions as F

from clickscope.operators import ads as AD
from clickscope.operators import sampling as SM
from clickscope.params import FIXTURE_PARAMS
from clickscope.plans.jobs import session_report
from clickscope.plans.registry import QUERIES
from clickscope.sources.fixtures import Fixture

EXPECTED = {
    "/root/testdata/sf0.001": dict(
        sessions=153, steps=(1, 88), longest=2131, zero=36, after_age=88, actions=478, universe=98,
        top=(67, 4, 1, 1), pv1=109, pairs=[9, 11, 10, 5, 9, 7], clicks=210, city_groups=993, top3_rows=830,
        user_groups=943, max_clicks=3, over1=15, over2=3, minute_rows=999, sample_1000=88, sample_100=72,
        step_buckets=[106, 26, 1, 14, 1, 5]),
    "/root/testdata/sf0.01": dict(
        sessions=1537, steps=(1, 86), longest=2156, zero=359, after_age=779, actions=5041, universe=100,
        top=(84, 19, 28, 10), pv1=971, pairs=[95, 72, 79, 82, 75, 90], clicks=2006, city_groups=7871,
        top3_rows=900, user_groups=9486, max_clicks=3, over1=144, over2=17, minute_rows=9950, sample_1000=686,
        sample_100=0, step_buckets=[1048, 282, 6, 147, 17, 37]),
}


@pytest.mark.parametrize("sf", sorted(EXPECTED))
def test_checked_values(spark, sf):
    e = EXPECTED[sf]
    summ = QUERIES["session_summary"](spark, sf)
    r = summ.agg(F.count(F.lit(1)).alias("n"), F.min("step_length").alias("lo"), F.max("step_length").alias("hi"),
                 F.max("visit_length").alias("longest"), F.count_if(F.col("visit_length") == 0).alias("zero")).first()
    assert (r.n, (r.lo, r.hi), r.longest, r.zero) == (e["sessions"], e["steps"], e["longest"], e["zero"])
    buckets = dict((x.step_bucket, x.c) for x in QUERIES["session_buckets"](spark, sf)
                   .groupBy("step_bucket").agg(F.count(F.lit(1)).alias("c")).collect())
    assert [buckets.get(b, 0) for b in ["1_3", "4_6", "7_9", "10_30", "30_60", "60"]] == e["step_buckets"]
    assert QUERIES["filter_between"](spark, sf).count() == e["after_age"]
    assert QUERIES["actions_of_filtered"](spark, sf).count() == e["actions"]
    assert QUERIES["category_universe"](spark, sf).count() == e["universe"]
    assert tuple(QUERIES["top_categories"](spark, sf).orderBy(F.desc("click_count"), F.desc("order_count"),
                                                               F.desc("pay_count"), "category_id").first()) == e["top"]
    assert QUERIES["start_page_pv"](spark, sf).first()["pv"] == e["pv1"]
    pairs = {x.pair: x.cnt for x in QUERIES["page_pairs"](spark, sf).collect()}
    assert [pairs[f"{i}_{i + 1}"] for i in range(1, 7)] == e["pairs"]
    assert QUERIES["area_clicks"](spark, sf).count() == e["clicks"]
    clicks = AD.parse_log_lines(Fixture(spark, sf).ad_log()).where("valid")
    assert AD.city_counts(clicks).count() == e["city_groups"]
    assert QUERIES["ads_province_top3"](spark, sf).count() == e["top3_rows"]
    uc = QUERIES["ads_user_counts"](spark, sf)
    assert uc.count() == e["user_groups"] and uc.agg(F.max("click_count")).first()[0] == e["max_clicks"]
    assert AD.blacklist_from_counts(uc, 1).count() == e["over1"]
    assert AD.blacklist_from_counts(uc, 2).count() == e["over2"]
    assert QUERIES["session_sample"](spark, sf).count() == e["sample_1000"]
    filtered = session_report(spark, sf, FIXTURE_PARAMS).filtered
    assert SM.session_sample(filtered, 100, FIXTURE_PARAMS.sample_seed).count() == e["sample_100"]
    assert AD.minute_trend(clicks).count() == e["minute_rows"]
