"""Schemas of the input and output tables."""

from pyspark.sql import types as T

VISIT_LOG = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("action_time", T.StringType()),
    T.StructField("search_keyword", T.StringType()),
    T.StructField("click_category_id", T.LongType()),
    T.StructField("click_product_id", T.LongType()),
    T.StructField("order_category_ids", T.StringType()),
    T.StructField("order_product_ids", T.StringType()),
    T.StructField("pay_category_ids", T.StringType()),
    T.StructField("pay_product_ids", T.StringType()),
    T.StructField("city_id", T.LongType()),
    # tie-break for actions in the same second (not in the original model)
    T.StructField("event_id", T.LongType()),
])

USER_INFO = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("username", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("professional", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("sex", T.StringType()),
])

PRODUCT_INFO = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("extend_info", T.StringType()),
])

CITY_INFO = T.StructType([
    T.StructField("city_id", T.LongType()),
    T.StructField("city_name", T.StringType()),
    T.StructField("area", T.StringType()),
])

# One ad click after parsing the log line ``ts_ms province city userid adid``.
AD_CLICK = T.StructType([
    T.StructField("ts_ms", T.LongType()),
    T.StructField("province", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("userid", T.LongType()),
    T.StructField("adid", T.LongType()),
])

# The raw ad log: one text line per click (plus the event id of the fixture).
AD_LOG = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("value", T.StringType()),
])

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
