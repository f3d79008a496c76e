from clickscope.operators import funnel as FN
from tests.conftest import rows
from tests.helpers import action, actions_df


def _acts(spark):
    return actions_df(spark, [
        # s1: 1 -> 2 -> 3, the 2 and 3 in the same second: event id decides
        action("s1", "2024-01-01 10:00:00", event_id=1, page_id=1),
        action("s1", "2024-01-01 10:00:05", event_id=3, page_id=3),
        action("s1", "2024-01-01 10:00:05", event_id=2, page_id=2),
        # s2: 1 -> 2
        action("s2", "2024-01-01 11:00:00", event_id=4, page_id=1),
        action("s2", "2024-01-01 11:00:01", event_id=5, page_id=2),
        # s3: a lone view of page 1
        action("s3", "2024-01-01 12:00:00", event_id=6, page_id=1),
    ])


def test_transitions_order_and_tie_break(spark):
    assert rows(FN.page_transitions(_acts(spark))) == [("s1", 1, "1_2"), ("s1", 2, "2_3"), ("s2", 4, "1_2")]


def test_pairs_pv_and_conversion(spark):
    a = _acts(spark)
    flow = (1, 2, 3, 4)
    assert rows(FN.page_pairs(a, flow)) == [("1_2", 2), ("2_3", 1)]
    assert rows(FN.start_page_pv(a, flow)) == [(1, 3)]
    # step 3 (3_4) has no transitions -> 0; its rate is 0 / 1
    assert rows(FN.funnel_conversion(a, flow)) == [(1, "1_2", 2, 0.67), (2, "2_3", 1, 0.5), (3, "3_4", 0, 0.0)]
    raw = rows(FN.funnel_conversion(a, flow, rounded=False))
    assert raw[0][3] == 2 / 3
    assert rows(FN.funnel_string(a, flow)) == [("1_2=0.67|2_3=0.50|3_4=0.00",)]


def test_zero_denominator_is_null(spark):
    a = _acts(spark)
    got = rows(FN.funnel_conversion(a, (7, 1, 2)))
    # no views of page 7 -> step 1 rate null; 7_1 count 0 -> step 2 rate null
    assert got == [(1, "7_1", 0, None), (2, "1_2", 2, None)]
    assert rows(FN.funnel_string(a, (7, 1, 2))) == [("7_1=null|1_2=null",)]


def test_actions_without_time_sort_first(spark):
    from clickscope.schemas import VISIT_LOG
    data = [action("s", "2024-01-01 10:00:00", event_id=2, page_id=2),
            ("2024-01-01", 1, "s", 1, None, None, -1, -1, None, None, None, None, 0, 1)]
    assert rows(FN.page_transitions(spark.createDataFrame(data, VISIT_LOG))) == [("s", 1, "1_2")]
