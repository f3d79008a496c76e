from clickscope.operators import categories as C
from tests.conftest import rows
from tests.helpers import action, actions_df


def _acts(spark):
    return actions_df(spark, [
        action("a", "2024-01-01 10:00:00", event_id=1, click=1),
        action("a", "2024-01-01 10:00:01", event_id=2, click=1),
        action("b", "2024-01-01 10:00:02", event_id=3, click=2),
        action("b", "2024-01-01 10:00:03", event_id=4, orders="2,2"),
        action("c", "2024-01-01 10:00:04", event_id=5, orders="3", pays="3,x"),
        # a row that clicks and orders at once counts for both
        action("c", "2024-01-01 10:00:05", event_id=6, click=4, orders="5"),
        action("d", "2024-01-01 10:00:06", event_id=7, click=1),
        action("d", "2024-01-01 10:00:07", event_id=8, click=2),
    ])


def test_counts(spark):
    a = _acts(spark)
    assert rows(C.category_clicks(a)) == [(1, 3), (2, 2), (4, 1)]
    assert rows(C.category_orders(a)) == [(2, 2), (3, 1), (5, 1)]
    assert rows(C.category_pays(a)) == [(3, 1)]
    assert rows(C.category_universe(a)) == [(1,), (2,), (3,), (4,), (5,)]
    assert rows(C.category_counts(a)) == [(1, 3, 0, 0), (2, 2, 2, 0), (3, 0, 1, 1), (4, 1, 0, 0), (5, 0, 1, 0)]


def test_top_categories_order_and_ties(spark):
    top = C.top_categories(_acts(spark), 3).collect()
    assert [r.category_id for r in top] == [1, 2, 4]


def test_top_sessions_per_category(spark):
    a = _acts(spark)
    got = rows(C.top_sessions_per_category(a, 2, 1))
    # category 1: a has 2 clicks; category 2: b and d tie at 1 -> smaller id
    assert got == [(1, "a", 2), (2, "b", 1)]
    assert rows(C.session_category_clicks(a, C.top_categories(a, 1))) == [(1, "a", 2), (1, "d", 1)]


def test_empty_input(spark):
    a = _acts(spark).where("1 = 0")
    assert C.category_counts(a).count() == 0
    assert C.top_sessions_per_category(a).count() == 0
