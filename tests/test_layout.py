"""The visit log by session: results as on the plain log, and no exchange of the log."""

import re

import pytest
from pyspark.sql import functions as F

from clickscope.operators import funnel, sessions
from clickscope.params import FIXTURE_PARAMS
from clickscope.plans.jobs import SessionReport
from clickscope.sources import layout
from clickscope.sources.fixtures import Fixture
from clickscope.sources.tables import actions_in_range
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def logs(spark):
    plain = Fixture(spark, SF).visit_log()
    layout.save_by_session(plain, "visits_by_session", 4)
    return plain, layout.load_by_session(spark, "visits_by_session")


def _exchanges(df) -> list[str]:
    """Exchanges of a plan, with what stands below each."""
    text = df._jdf.queryExecution().sparkPlan().toString()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert text
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", final)


def test_same_rows(logs):
    plain, by_session = logs
    assert by_session.columns == plain.columns and rows(by_session) == rows(plain)


def test_summary_needs_no_exchange(logs):
    plain, by_session = logs
    acts = actions_in_range(by_session, FIXTURE_PARAMS)
    got = sessions.session_summary(acts)
    assert _exchanges(got) == []
    assert len(_exchanges(sessions.session_summary(plain))) == 2
    assert rows(got) == rows(sessions.session_summary(actions_in_range(plain, FIXTURE_PARAMS)))


def test_successor_needs_no_exchange(logs):
    plain, by_session = logs
    got = funnel.page_transitions(by_session)
    assert _exchanges(got) == []
    assert rows(got) == rows(funnel.page_transitions(plain))


def test_actions_of_sessions_exchange_the_sessions_alone(spark, logs):
    plain, by_session = logs
    users = Fixture(spark, SF).users()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        report = SessionReport(by_session, users, FIXTURE_PARAMS).written()
        got = sessions.actions_of_sessions(by_session, report.filtered)
        assert len(_exchanges(got)) == 1  # the filtered sessions come to the buckets
        assert rows(got) == rows(SessionReport(plain, users, FIXTURE_PARAMS).filtered_actions)
        # a summary of the same log meets it in place
        own = sessions.session_summary(by_session).where("step_length > 3")
        assert _exchanges(sessions.actions_of_sessions(by_session, own)) == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_large_session_is_refused(spark, logs):
    plain, _ = logs
    hot = plain.withColumn("session_id", F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.col("session_id")))
    with pytest.raises(layout.UnevenSessions):
        layout.save_by_session(hot, "visits_hot", 4)
    assert not spark.catalog.tableExists("visits_hot")
