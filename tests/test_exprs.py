from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickscope.functions import exprs as X


def _one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("x")).collect()]


def _passes(spark, pred, data, schema):
    """Which rows a predicate keeps under ``where`` (null counts as false)."""
    return [bool(v) for v in _one(spark, pred, data, schema)]


def test_visit_bucket_edges(spark):
    cases = {0: None, 1: "1s_3s", 3: "1s_3s", 4: "4s_6s", 6: "4s_6s", 7: "7s_9s", 9: "7s_9s", 10: "10s_30s",
             30: "10s_30s", 31: "30s_60s", 60: "30s_60s", 61: "1m_3m", 180: "1m_3m", 181: "3m_10m", 600: "3m_10m",
             601: "10m_30m", 1800: "10m_30m", 1801: "30m", 100000: "30m"}
    data = [(k,) for k in cases]
    got = _one(spark, X.visit_bucket("v"), data, "v bigint")
    assert dict(zip(cases, got)) == cases


def test_step_bucket_edges(spark):
    cases = {0: None, 1: "1_3", 3: "1_3", 4: "4_6", 6: "4_6", 7: "7_9", 9: "7_9", 10: "10_30", 30: "10_30",
             31: "30_60", 60: "30_60", 61: "60"}
    got = _one(spark, X.step_bucket("v"), [(k,) for k in cases], "v bigint")
    assert dict(zip(cases, got)) == cases


def _half_up(n, d):
    return float((Decimal(n) / Decimal(d)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def test_half_up_ratio_known_halves(spark):
    data = [(29, 200), (201, 200), (1, 3), (2, 3), (0, 5), (5, 0), (7, 7), (1, 8)]
    got = _one(spark, X.half_up_ratio("n", "d"), data, "n bigint, d bigint")
    assert got == [0.15, 1.01, 0.33, 0.67, 0.0, None, 1.0, 0.13]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5000), st.integers(1, 5000)), min_size=1, max_size=30))
def test_half_up_ratio_matches_decimal(spark, pairs):
    got = _one(spark, X.half_up_ratio("n", "d"), pairs, "n bigint, d bigint")
    assert got == [_half_up(n, d) for n, d in pairs]


def test_between_missing_bounds_and_null(spark):
    data = [(25,), (19,), (None,)]
    assert _passes(spark, X.between_or_true("a", 20, 50), data, "a int") == [True, False, False]
    assert _passes(spark, X.between_or_true("a", None, 50), data, "a int") == [True, True, True]


def test_in_any_and_equal(spark):
    data = [("a",), ("-1",), (None,), ("c",)]
    assert _passes(spark, X.in_any("s", ("a", "b")), data, "s string") == [True, False, False, False]
    assert _passes(spark, X.in_any("s", ("a", "-1")), data, "s string") == [True, False, False, False]
    assert _passes(spark, X.in_any("s", None), data, "s string") == [True] * 4
    assert _passes(spark, X.equal_or_true("s", "c"), data, "s string") == [False, False, False, True]
    assert _passes(spark, X.equal_or_true("s", ""), data, "s string") == [True] * 4


def test_csv_overlap_is_whole_item(spark):
    data = [("112,5",), ("12",), ("",), (None,), ("3,12,40",)]
    assert _passes(spark, X.csv_overlap("s", ("12",)), data, "s string") == [False, True, False, False, True]


def test_kv_get(spark):
    data = [("a=1|b=2|a=3",), ("b=|a=x",), ("a=1=2|a=y",), ("c=1",), (None,), ("a=v=|a=w",), ("a==|=a|a=z|",)]
    assert _one(spark, X.kv_get("s", "a"), data, "s string") == ["1", "x", "y", None, None, "v", "z"]
    assert _one(spark, X.kv_get("s", "b"), data, "s string") == ["2", None, None, None, None, None, None]


def test_kv_set_keeps_order(spark):
    assert _one(spark, X.kv_set("s", "b", "9"), [("a=1|b=2|c=3",)], "s string") == ["a=1|b=9|c=3"]


def test_trim_comma_and_pad(spark):
    assert _one(spark, X.trim_comma("s"), [(",a,b,",), ("a",), (",,",)], "s string") == ["a,b", "a", ""]
    assert _one(spark, X.pad2("s"), [("5",), ("12",)], "s string") == ["05", "12"]


def test_json_and_status(spark):
    data = [('{"product_status":0}',), ('{"product_status":1}',), ("not json",)]
    assert _one(spark, X.json_field("j", "product_status"), data, "j string") == ["0", "1", None]
    assert _one(spark, X.product_status("j"), data, "j string") == ["Self", "Third Party", "Third Party"]


def test_area_level(spark):
    data = [("华北",), ("华东",), ("华中",), ("华南",), ("西南",), ("西北",), ("东北",), (None,)]
    assert _one(spark, X.area_level("a"), data, "a string") == [
        "A_Level", "A_Level", "B_Level", "B_Level", "C_Level", "C_Level", "D_Level", "D_Level"]


def test_concat_long_string_and_csv(spark):
    assert _one(spark, X.concat_long_string("i", "s", ":"), [(3, "x")], "i bigint, s string") == ["3:x"]
    assert _one(spark, X.csv_to_longs("s"), [("1,2,2,x",)], "s string") == [[1, 2, 2]]


def test_times(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05", "2024-01-02 03:05:00")], "a string, b string")
    r = df.select(X.seconds_between(X.parse_time("a"), X.parse_time("b")).alias("d"),
                  X.date_hour(X.parse_time("a")).alias("h"),
                  X.format_minute(X.parse_time("a")).alias("m"),
                  X.format_date_key(X.parse_time("a")).alias("k"),
                  X.parse_time(F.lit("bad")).alias("bad")).first()
    assert (r.d, r.h, r.m, r.k, r.bad) == (55, "2024-01-02_03", "202401020304", "20240102", None)


def test_int_div(spark):
    assert _one(spark, X.int_div("a", "b"), [(7, 2), (1000, 30), (0, 3)], "a bigint, b bigint") == [3, 33, 0]


def test_group_concat_distinct(spark):
    df = spark.createDataFrame([("x", "b"), ("x", "a"), ("x", "b"), ("y", "c")], "k string, v string")
    got = {r.k: r.s for r in df.groupBy("k").agg(X.group_concat_distinct("v").alias("s")).collect()}
    assert got == {"x": "a,b", "y": "c"}


def test_date_keys_and_today(spark):
    import datetime as dt
    r = spark.createDataFrame([("20240131", "x")], "a string, b string").select(
        X.parse_date_key("a").alias("d"), X.parse_date_key("b").alias("bad"), X.today().alias("t"),
        X.yesterday().alias("y"), X.is_empty("b").alias("e"), X.is_not_empty("b").alias("ne")).first()
    assert r.d == dt.date(2024, 1, 31) and r.bad is None
    assert len(r.t) == 10 and r.y < r.t and (r.e, r.ne) == (False, True)


def test_before_after(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:01", "2024-01-01 00:00:02")], "a string, b string")
    r = df.select(X.before(X.parse_time("a"), X.parse_time("b")).alias("bf"),
                  X.after(X.parse_time("a"), X.parse_time("b")).alias("af")).first()
    assert (r.bf, r.af) == (True, False)


def test_json_field_with_a_quote_in_its_name(spark):
    df = spark.createDataFrame([('{"it\'s": 5, "a?b": {"c": 1}}',), ("no json",), (None,)], "j string")
    got = [tuple(r) for r in df.select(X.json_field("j", "it's"), X.json_field("j", "a?b"), X.json_field("j", "none?")).collect()]
    assert got == [("5", '{"c":1}', None), (None, None, None), (None, None, None)]
