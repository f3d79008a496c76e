from clickscope.operators import sampling as SM
from tests.conftest import rows


def _sessions(spark, n_by_hour):
    data = []
    for (date, hour), n in n_by_hour.items():
        for i in range(n):
            data.append((f"{date}_{hour}_{i}", f"{date} {hour}:00:{i % 60:02d}", "", ""))
    return spark.createDataFrame(data, "session_id string, start_time string, search_keywords string, "
                                       "click_category_ids string")


def test_quota_integer_arithmetic(spark):
    s = _sessions(spark, {("2024-01-01", "00"): 3, ("2024-01-01", "01"): 7, ("2024-01-02", "05"): 10})
    got = rows(SM.sample_quota(s, 9))
    # 2 days -> 4 per day; day 1: 3*4//10 = 1, 7*4//10 = 2; day 2: min(10, 10*4//10) = 4
    assert got == [("2024-01-01", "00", 3, 1), ("2024-01-01", "01", 7, 2), ("2024-01-02", "05", 10, 4)]


def test_quota_capped_by_count(spark):
    s = _sessions(spark, {("2024-01-01", "00"): 2})
    assert rows(SM.sample_quota(s, 1000)) == [("2024-01-01", "00", 2, 2)]


def test_sample_sizes_and_repeatability(spark):
    s = _sessions(spark, {("2024-01-01", "00"): 30, ("2024-01-01", "01"): 50, ("2024-01-02", "03"): 40})
    quota = {(r.date, r.hour): r.quota for r in SM.sample_quota(s, 20).collect()}
    a = SM.session_sample(s, 20, "seed")
    got = rows(a, "session_id")
    assert len(got) == len(set(got)) == sum(quota.values())
    per_hour = {}
    for (sid,) in got:
        d, h, _ = sid.split("_")
        per_hour[(d, h)] = per_hour.get((d, h), 0) + 1
    assert per_hour == {k: v for k, v in quota.items() if v}
    # independent of the input partitioning, changes with the seed
    b = SM.session_sample(s.repartition(7), 20, "seed")
    assert rows(b, "session_id") == got
    assert rows(SM.session_sample(s, 20, "other"), "session_id") != got


def test_sample_detail(spark):
    from tests.helpers import action, actions_df
    acts = actions_df(spark, [action("x", "2024-01-01 00:00:01", event_id=1),
                              action("y", "2024-01-01 00:00:02", event_id=2)])
    sample = spark.createDataFrame([("x", "2024-01-01 00:00:01", "", "")],
                                   "session_id string, start_time string, search_keywords string, "
                                   "click_category_ids string")
    assert [r.session_id for r in SM.session_sample_detail(acts, sample, 10).collect()] == ["x"]


def test_sessions_per_day_and_hour(spark):
    s = _sessions(spark, {("2024-01-01", "00"): 3, ("2024-01-01", "05"): 2, ("2024-01-02", "05"): 4})
    assert rows(SM.sessions_per_day(s)) == [("2024-01-01", 5), ("2024-01-02", 4)]
    assert rows(SM.sessions_per_hour(s)) == [("2024-01-01", "00", 3), ("2024-01-01", "05", 2), ("2024-01-02", "05", 4)]


def test_cutoff_never_changes_the_sample(spark):
    """Cutoffs that leave no candidate, too few, or all: the hours are topped up exactly."""
    rows_ = [(f"s{i}", f"2024-01-0{1 + i % 3} {i % 5:02d}:00:00", "", "") for i in range(600)]
    s = spark.createDataFrame(rows_, "session_id string, start_time string, search_keywords string, click_category_ids string")
    want = rows(SM.session_sample(s, 90, "7", spare=1e9), "session_id")
    assert len(want) >= 80
    for spare in (-50.0, -1.0, 0.0, 6.0):
        assert rows(SM.session_sample(s, 90, "7", spare=spare), "session_id") == want


def test_only_candidates_near_the_quota_are_ranked(spark):
    rows_ = [(f"s{i}", "2024-01-01 03:00:00", "", "") for i in range(20_000)]
    s = spark.createDataFrame(rows_, "session_id string, start_time string, search_keywords string, click_category_ids string")
    q = SM.with_cutoff(SM.sample_quota(s, 100)).first()
    draws = s.selectExpr("md5(concat('x', session_id)) as d").where(f"d < '{q['cutoff']}'").count()
    assert q["quota"] == 100 and 100 <= draws <= 250
