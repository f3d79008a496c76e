from pyspark.sql import functions as F

from clickscope.operators import ads as AD
from tests.conftest import rows

T0 = 1704067200000  # 2024-01-01 00:00:00 UTC in ms


def _lines(spark, lines):
    return spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "event_id bigint, value string")


def test_parse_rejects_malformed(spark):
    lines = [f"{T0} p0 c0 7 3", "garbage", f"{T0} p0 c0 x 3", f"{T0} p0 c0 7", f"{T0} p0 c0 7 3 9", "", None]
    p = AD.parse_log_lines(_lines(spark, lines))
    got = rows(p, "event_id", "valid", "userid", "adid")
    assert got[0] == (0, True, 7, 3)
    # further fields are passed over, as a split into fields does
    assert [r[1] for r in got] == [True, False, False, False, True, False, False]
    first = p.where("valid").first()
    assert first.ts_ms == T0 and first.province == "p0" and first.city == "c0"


def _clicks(spark):
    minute = 60_000
    lines = [f"{T0 + i * minute} p{i % 2} c{i % 4} {u} {ad}" for i, (u, ad) in enumerate(
        [(1, 5), (1, 5), (1, 5), (2, 5), (2, 6), (3, 7), (3, 7), (4, 8)])]
    return AD.parse_log_lines(_lines(spark, lines)).where("valid")


def test_user_counts_and_blacklist(spark):
    c = _clicks(spark)
    counts = AD.user_ad_counts(c)
    assert rows(counts) == [("20240101", 1, 5, 3), ("20240101", 2, 5, 1), ("20240101", 2, 6, 1),
                            ("20240101", 3, 7, 2), ("20240101", 4, 8, 1)]
    black = AD.blacklist_from_counts(counts, 2)
    assert rows(black) == [(1,)]
    kept = AD.exclude_blacklisted(c, black)
    assert sorted(r.userid for r in kept.collect()) == [2, 2, 3, 3, 4]


def test_city_province_top(spark):
    c = _clicks(spark)
    city = AD.city_counts(c)
    prov = AD.province_counts(city)
    assert rows(prov) == [("20240101", "p0", 5, 2), ("20240101", "p0", 6, 1), ("20240101", "p0", 7, 1),
                          ("20240101", "p1", 5, 2), ("20240101", "p1", 7, 1), ("20240101", "p1", 8, 1)]
    assert rows(city.groupBy().sum("click_count")) == [(8,)]
    top = rows(AD.province_top(prov, 2))
    # ties at 1 click -> the smaller ad id wins
    assert top == [("20240101", "p0", 5, 2), ("20240101", "p0", 6, 1), ("20240101", "p1", 5, 2),
                   ("20240101", "p1", 7, 1)]


def test_minute_trend(spark):
    got = rows(AD.minute_trend(_clicks(spark)))
    assert got[0] == ("20240101", "00", "00", 5, 1)
    assert len(got) == 8


def test_sliding_hour_matches_builtin_window(spark):
    """Brute force: Spark's own sliding window() expands every click."""
    import random
    rnd = random.Random(3)
    lines = [f"{T0 + rnd.randrange(0, 5 * 3600_000)} p0 c0 1 {rnd.randrange(3)}" for _ in range(300)]
    c = AD.parse_log_lines(_lines(spark, lines)).where("valid")
    fast = rows(AD.sliding_hour(c))
    w = c.groupBy(F.window("ts", "60 minutes", "1 minute").alias("w"), "adid").agg(F.count(F.lit(1)).alias("n"))
    fmt = "yyyy-MM-dd HH:mm:ss"
    brute = rows(w.select(F.date_format("w.start", fmt), F.date_format("w.end", fmt), "adid", "n"))
    assert fast == brute
