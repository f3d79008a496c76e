from pyspark.sql import functions as F

from clickscope.operators import area as A
from clickscope.sources.fixtures import cities, products_from_part
from tests.conftest import rows


def _clicks(spark):
    # (city_id, click_product_id); city 42 is not in the dimension
    return spark.createDataFrame([(0, 10), (0, 10), (1, 10), (2, 10), (1, 11), (3, 12), (4, 12), (42, 10),
                                  (5, 13), (6, 99), (7, 14), (8, 14)], "city_id bigint, click_product_id bigint")


def _products(spark):
    part = spark.createDataFrame([(10, "p10", 2), (11, "p11", 3), (12, "p12", 4), (13, "p13", 5), (14, "p14", 6)],
                                 "p_partkey bigint, p_name string, p_size int")
    return products_from_part(part)


def test_base_drops_unknown_city(spark):
    base = A.area_base(_clicks(spark), cities(spark))
    assert base.count() == 11


def test_counts_and_city_infos(spark):
    base = A.area_base(_clicks(spark), cities(spark))
    got = {(r.area, r.pid): (r.click_count, r.city_infos) for r in A.area_product_clicks(base).collect()}
    assert got[("华北", 10)] == (2, "0:北京")
    assert got[("华东", 10)] == (2, "1:上海,2:南京")
    infos = {r.area: r.city_infos for r in A.area_city_infos(base.repartition(5)).collect()}
    assert infos["华南"] == "3:广州,4:三亚"


def test_top3_and_unknown_product(spark):
    base = A.area_base(_clicks(spark), cities(spark))
    info = A.area_product_info(A.area_product_clicks(base), _products(spark))
    # product 99 is unknown and drops
    assert info.where(F.col("pid") == 99).count() == 0
    top = rows(A.area_top3(info, 1), "area", "area_level", "pid", "product_status")
    assert ("华东", "A_Level", 10, "Self") in top
    assert ("华中", "B_Level", 13, "Third Party") in top
    assert ("西北", "C_Level", 14, "Self") in top


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from clickscope.sources.fixtures import CITY_ROWS  # noqa: E402


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 4)), min_size=1, max_size=60), st.integers(1, 7))
def test_city_infos_independent_of_partitioning(spark, clicks, parts):
    df = spark.createDataFrame(clicks, "city_id bigint, click_product_id bigint")
    a = rows(A.area_product_clicks(A.area_base(df, cities(spark))))
    b = rows(A.area_product_clicks(A.area_base(df.repartition(parts), cities(spark))))
    assert a == b
    info = {cid: (f"{cid}:{name}", area) for cid, name, area in CITY_ROWS}
    want = {}
    for cid, pid in clicks:
        label, area = info[cid]
        cnt, labels = want.get((area, pid), (0, set()))
        want[(area, pid)] = (cnt + 1, labels | {label})
    assert a == sorted((ar, pid, cnt, ",".join(sorted(ls))) for (ar, pid), (cnt, ls) in want.items())
