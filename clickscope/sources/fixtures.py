"""Derive the visit log, user, product, city and ad-log tables from the
driver's ``events`` / ``customer`` / ``part`` tables.

All derivations are narrow projections: at any scale they run as one pass over
the scanned columns, and Catalyst prunes the unused ones.  Only the write of the
visit log shuffles, to lay its rows out by day and session.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickscope.session import fs_exists, fs_files, fs_publish, work_dir
from clickscope.schemas import AD_LOG, CITY_INFO, PRODUCT_INFO, USER_INFO, VISIT_LOG

# The city dimension of the original jobs (city_id, city_name, area).
CITY_ROWS = [
    (0, "北京", "华北"),
    (1, "上海", "华东"),
    (2, "南京", "华东"),
    (3, "广州", "华南"),
    (4, "三亚", "华南"),
    (5, "武汉", "华中"),
    (6, "长沙", "华中"),
    (7, "西安", "西北"),
    (8, "成都", "西南"),
    (9, "哈尔滨", "东北"),
]

FIXTURE_EPOCH = "2024-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> Column:
    return F.expr("try_cast(get_json_object(props, '$.k') AS BIGINT)")


def visit_log_from_events(events: DataFrame) -> DataFrame:
    """Map each event to one visit-log action (FIXTURES.md part B)."""
    n = F.when(F.col("user_id") % 3 == 0, 1).when(F.col("user_id") % 3 == 1, 10).otherwise(30)
    ev = events.select(
        "event_id", "ts", "user_id", "event_type", _k().alias("k"), n.alias("n"),
        F.to_date("ts").alias("d"),
    )
    # b: start of the user's n-day bucket; the session is (user, b)
    ev = ev.withColumn(
        "b", F.expr(f"date_add(DATE'{FIXTURE_EPOCH}', CAST((datediff(d, DATE'{FIXTURE_EPOCH}') div n) * n AS INT))")
    ).withColumn("b_ts", F.col("b").cast("timestamp_ntz"))
    # time inside the session: hour of the user + elapsed seconds compressed by 40 n
    ev = ev.withColumn("offset_s", F.expr("(user_id % 24) * 3600 + timestampdiff(SECOND, b_ts, ts) div (40 * n)"))
    action_ts = F.expr("timestampadd(SECOND, offset_s, b_ts)")
    etype = F.col("event_type")
    k = F.col("k")
    order_ids = F.when(etype == "signup", F.concat_ws(",", k.cast("string"), ((k * 7 + 1) % 100).cast("string")))
    pay_ids = F.when(etype == "purchase", k.cast("string"))
    return ev.select(
        F.date_format("b", "yyyy-MM-dd").alias("date"),
        F.col("user_id").cast("bigint").alias("user_id"),
        F.concat(F.col("user_id").cast("string"), F.lit("_"), F.date_format("b", "yyyyMMdd")).alias("session_id"),
        (k % 10).cast("bigint").alias("page_id"),
        F.date_format(action_ts, "yyyy-MM-dd HH:mm:ss").alias("action_time"),
        F.when(etype == "error", F.concat(F.lit("kw"), (k % 10).cast("string"))).alias("search_keyword"),
        F.when(etype == "click", k).otherwise(F.lit(-1)).cast("bigint").alias("click_category_id"),
        F.when(etype == "click", k * 2).otherwise(F.lit(-1)).cast("bigint").alias("click_product_id"),
        order_ids.alias("order_category_ids"),
        order_ids.alias("order_product_ids"),
        pay_ids.alias("pay_category_ids"),
        pay_ids.alias("pay_product_ids"),
        (F.col("user_id") % 10).cast("bigint").alias("city_id"),
        F.col("event_id").cast("bigint").alias("event_id"),
    )


def users_from_customer(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    return customer.select(
        key.cast("bigint").alias("user_id"),
        F.col("c_name").alias("username"),
        F.col("c_name").alias("name"),
        ((key * 37) % 60).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.concat(F.lit("city"), F.col("c_nationkey").cast("string")).alias("city"),
        F.when(key % 2 == 0, "male").otherwise("female").alias("sex"),
    )


def products_from_part(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").cast("bigint").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit('{"product_status":'), (F.col("p_size") % 2).cast("string"), F.lit("}")).alias("extend_info"),
    )


def cities(spark: SparkSession) -> DataFrame:
    """The fixed 10-row city dimension (size is a constant: safe to broadcast)."""
    return spark.createDataFrame(CITY_ROWS, CITY_INFO)


def ad_clicks_from_events(events: DataFrame) -> DataFrame:
    """One ad click per event: event id, epoch millis, province, city, user, ad."""
    slot = F.col("event_id") % 30
    return events.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        F.expr("unix_millis(CAST(ts AS TIMESTAMP))").alias("ts_ms"),
        F.concat(F.lit("p"), F.floor(slot / 3).cast("string")).alias("province"),
        F.concat(F.lit("c"), slot.cast("string")).alias("city"),
        F.col("user_id").cast("bigint").alias("userid"),
        (_k() % 20).cast("bigint").alias("adid"),
    )


def ad_log_lines(events: DataFrame) -> DataFrame:
    """The ad log as raw text lines ``ts_ms province city userid adid`` (+ event_id)."""
    c = ad_clicks_from_events(events)
    return c.select(
        "event_id",
        F.concat_ws(" ", F.col("ts_ms").cast("string"), "province", "city",
                    F.col("userid").cast("string"), F.col("adid").cast("string")).alias("value"),
    )


# Bump when a derivation above changes: it keys the materialized copies.
FIXTURE_VERSION = "2"


def _source_signature(spark: SparkSession, sf_dir: str) -> str:
    """Digest of the source files' names, sizes and times, as the file system (any that
    Spark reads) reports them: a replaced table has another one."""
    parts = [FIXTURE_VERSION]
    for name in ("events", "customer", "part"):
        path = f"{sf_dir.rstrip('/')}/{name}.parquet"
        parts += [f"{p}:{size}:{at}" for p, size, at in fs_files(spark, path)]
    return hashlib.sha1("|".join(parts).encode()).hexdigest()[:16]


class Fixture:
    """The derived tables of one scale-factor folder.

    On first use in a session the derived tables are written once to the
    shared working folder (``spark.checkpoint.dir``) - the visit log
    partitioned by ``date``, the ad log as raw text lines - and every query
    then scans those tables, as the original jobs scan their Hive tables: a
    ``date`` range prunes partitions and pushes into the Parquet scan.  Each
    table is written to a staging folder and published by rename, so a
    failed or concurrent build never leaves a partial table behind.  Each
    use looks at the source files again; when they have changed, the
    tables are derived anew."""

    _built: set[tuple] = set()

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.materialize = materialize
        self._root = None

    # raw derivations (lazy, no materialization)
    def events(self) -> DataFrame:
        return table(self.spark, self.sf_dir, "events")

    def _derived(self) -> dict:
        return {
            "visit_log": lambda: visit_log_from_events(self.events()),
            "users": lambda: users_from_customer(table(self.spark, self.sf_dir, "customer")),
            "products": lambda: products_from_part(table(self.spark, self.sf_dir, "part")),
            "ad_log": lambda: ad_log_lines(self.events()),
        }

    def root(self) -> str:
        if self._root is None:
            root = f"{work_dir(self.spark).rstrip('/')}/fixture-{_source_signature(self.spark, self.sf_dir)}"
            key = (id(self.spark.sparkContext), root)
            if key not in Fixture._built:
                self._build(root)
                Fixture._built.add(key)
            self._root = root
        return self._root

    def _build(self, root: str) -> None:
        for name, make in self._derived().items():
            target = f"{root}/{name}"
            if fs_exists(self.spark, f"{target}/_SUCCESS"):
                continue
            staging = f"{root}/_staging/{name}-{uuid.uuid4().hex[:8]}"
            df = make()
            w = df.write.mode("overwrite")
            if name == "visit_log":
                # partitioned by day, so date ranges prune whole folders; range
                # partitioning on (date, session_id) keeps a day's rows in few
                # files and each session's rows together, while a large day
                # is still split over several writers
                w = df.repartitionByRange("date", "session_id").write.mode("overwrite").partitionBy("date")
            w.parquet(staging)
            # False: another build published the same table first (identical content)
            fs_publish(self.spark, staging, target)

    def _read(self, name: str, schema=None) -> DataFrame:
        if not self.materialize:
            return self._derived()[name]()
        r = self.spark.read
        if schema is not None:
            r = r.schema(schema)
        return r.parquet(f"{self.root()}/{name}")

    def visit_log(self) -> DataFrame:
        return self._read("visit_log", VISIT_LOG).select(*VISIT_LOG.fieldNames())

    def users(self) -> DataFrame:
        return self._read("users", USER_INFO)

    def products(self) -> DataFrame:
        return self._read("products", PRODUCT_INFO)

    def cities(self) -> DataFrame:
        return cities(self.spark)

    def ad_log(self) -> DataFrame:
        return self._read("ad_log", AD_LOG)

    def ad_log_path(self) -> str:
        return f"{self.root()}/ad_log"
