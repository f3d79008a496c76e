from hypothesis import given, settings
from hypothesis import strategies as st

from clickscope.operators import sessions as S
from clickscope.params import TaskParams
from tests.conftest import rows
from tests.helpers import action, actions_df, users_df


def _acts(spark):
    return actions_df(spark, [
        action("s1", "2024-01-01 10:00:00", event_id=1, keyword="kw2", user_id=1),
        action("s1", "2024-01-01 10:00:05", event_id=2, keyword="kw1", user_id=1),
        action("s1", "2024-01-01 10:00:05", event_id=3, keyword="kw2", click=112, user_id=1),
        action("s1", "2024-01-01 10:01:10", event_id=4, click=12, user_id=1),
        action("s1", "2024-01-01 10:01:11", event_id=5, keyword="", click=-1, user_id=1),
        action("s2", "2024-01-01 11:00:00", event_id=6, user_id=2),
        action("s3", "2024-01-02 09:00:00", event_id=7, user_id=99, click=5),
    ])


def test_session_summary(spark):
    got = rows(S.session_summary(_acts(spark)))
    assert got == [
        ("s1", 1, "kw1,kw2", "12,112", 71, 5, "2024-01-01 10:00:00"),
        ("s2", 2, "", "", 0, 1, "2024-01-01 11:00:00"),
        ("s3", 99, "", "5", 0, 1, "2024-01-02 09:00:00"),
    ]


def test_user_join_drops_unknown_users(spark):
    users = users_df(spark, [(1, 30, "p1", "city1", "male"), (2, 60, "p2", "city2", "female")])
    full = S.with_users(S.session_summary(_acts(spark)), users)
    assert rows(full, "session_id", "age") == [("s1", 30), ("s2", 60)]


def test_filters(spark):
    users = users_df(spark, [(1, 30, "p1", "city1", "male"), (2, 60, "p2", "city2", "female")])
    full = S.with_users(S.session_summary(_acts(spark)), users)

    def ids(**kw):
        return [r[0] for r in rows(S.filter_sessions(full, TaskParams(**kw)), "session_id")]

    assert ids(start_age=20, end_age=50) == ["s1"]
    assert ids(start_age=None, end_age=None) == ["s1", "s2"]
    assert ids(start_age=None, end_age=None, sex="female") == ["s2"]
    assert ids(start_age=None, end_age=None, keywords="kw1,kw9") == ["s1"]
    assert ids(start_age=None, end_age=None, category_ids="1,2") == []
    assert ids(start_age=None, end_age=None, category_ids="12") == ["s1"]
    assert ids(start_age=None, end_age=None, professionals="p2", cities="city2,city3") == ["s2"]
    assert ids(start_age=None, end_age=None, cities="") == ["s1", "s2"]


def test_stats_and_bucket_counts(spark):
    summ = S.session_summary(_acts(spark))
    st_ = S.session_stats(summ).first().asDict()
    assert st_["session_count"] == 3
    assert st_["visit_length_1m_3m_ratio"] == 0.33
    assert st_["visit_length_1s_3s_ratio"] == 0.0
    assert st_["step_length_1_3_ratio"] == 0.67
    assert st_["step_length_4_6_ratio"] == 0.33
    counts = dict(rows(S.session_bucket_counts(summ)))
    assert counts == {"session_count": 3, "1m_3m": 1, "1_3": 2, "4_6": 1}


def test_stats_on_empty_input(spark):
    empty = S.session_summary(_acts(spark)).where("1 = 0")
    r = S.session_stats(empty).first().asDict()
    assert r["session_count"] == 0
    assert all(v is None for k, v in r.items() if k != "session_count")


def test_actions_of_sessions_is_semi_join(spark):
    acts = _acts(spark)
    keep = S.session_summary(acts).where("session_id = 's2'")
    assert rows(S.actions_of_sessions(acts, keep), "event_id") == [(6,)]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 4000)), min_size=1, max_size=40))
def test_bucket_counts_property(spark, data):
    """visit buckets + zero-length sessions = session_count; step buckets = session_count."""
    acts = actions_df(spark, [
        action(f"s{s}", f"2024-01-01 {10 + off // 3600:02d}:{off % 3600 // 60:02d}:{off % 60:02d}", event_id=i)
        for i, (s, off) in enumerate(data)])
    summ = S.session_summary(acts)
    counts = dict(rows(S.session_bucket_counts(summ)))
    n = counts.pop("session_count")
    zero = summ.where("visit_length = 0").count()
    visit = sum(v for k, v in counts.items() if k.endswith("s") or k.endswith("m"))
    step = sum(v for k, v in counts.items() if not (k.endswith("s") or k.endswith("m")))
    assert visit + zero == n
    assert step == n == len({s for s, _ in data})


def test_null_and_malformed_action_times(spark):
    """Actions without a (valid) time count as steps but do not move the first
    or last time; a session with no valid time has no visit length/start."""
    from clickscope.schemas import VISIT_LOG
    rows_ = [
        action("a", "2024-01-01 10:00:00", event_id=1),
        action("a", "2024-01-01 10:00:30", event_id=2),
        ("2024-01-01", 1, "a", 0, None, None, -1, -1, None, None, None, None, 0, 3),
        ("2024-01-01", 1, "b", 0, "not a time", None, -1, -1, None, None, None, None, 0, 4),
    ]
    summ = {r.session_id: r for r in S.session_summary(spark.createDataFrame(rows_, VISIT_LOG)).collect()}
    assert (summ["a"].step_length, summ["a"].visit_length, summ["a"].start_time) == (3, 30, "2024-01-01 10:00:00")
    assert (summ["b"].step_length, summ["b"].visit_length, summ["b"].start_time) == (1, None, None)
    b = S.with_buckets(S.session_summary(spark.createDataFrame(rows_, VISIT_LOG))).where("session_id = 'b'").first()
    assert (b.visit_bucket, b.step_bucket) == (None, "1_3")
