"""Tiny literal inputs for unit tests."""

from clickscope.schemas import USER_INFO, VISIT_LOG


def action(session_id, action_time, *, event_id, user_id=1, page_id=0, keyword=None, click=-1,
           orders=None, pays=None, city_id=0, date=None):
    return (date or action_time[:10], user_id, session_id, page_id, action_time, keyword, click,
            (click * 2 if click != -1 else -1), orders, orders, pays, pays, city_id, event_id)


def actions_df(spark, rows):
    return spark.createDataFrame(rows, VISIT_LOG)


def users_df(spark, rows):
    """rows: (user_id, age, professional, city, sex)"""
    return spark.createDataFrame([(u, f"u{u}", f"n{u}", a, p, c, s) for u, a, p, c, s in rows], USER_INFO)
