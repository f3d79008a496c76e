"""The ad-click stream as Structured Streaming queries (JOB6, ST1-ST9).

Stage A (one query, ``foreachBatch``): parse the log lines, drop blacklisted
users' clicks, publish the batch's per-(date, user, ad) counts, the users that
they bring over the threshold, and the clean clicks.  Counts lie in folders of
(day, user bucket): a batch looks up its own keys there and reads no other folder.
The blacklist that batch N sees holds what batches ``< N`` published - repeatable
on replay, no mutable table.

Stage B (native stateful queries over the clean-click folder): running
per-(date, province, city, ad) totals with province top-3 refreshed each
batch, and per-minute ad trends.  State never expires unless a watermark is
given; ``start_trend_with_late`` bounds it and keeps late clicks in an output of
their own.  Results are published per batch id, so a replayed batch is
skipped and restarts resume from the checkpoint.

Every output may also go to database tables (``database_sink.TableSink``), each
batch in one transaction with its id.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickscope.operators import ads, sinks
from clickscope.operators.batch_log import BatchLog
from clickscope.operators.database_sink import TableSink
from clickscope.schemas import AD_LOG, EVENTS
from clickscope.session import fs_exists, fs_mkdirs, fs_read_text, fs_write_text, run_dir
from clickscope.sources.fixtures import ad_log_lines

CLEAN_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts_ms", T.LongType()),
    T.StructField("province", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("userid", T.LongType()),
    T.StructField("adid", T.LongType()),
])


# --- sources (SRC6) ------------------------------------------------------------

def kafka_lines(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
                options: dict | None = None) -> DataFrame:
    """Log lines from Kafka; ``event_id`` holds partition and offset (48 bits), so it
    is unique in the topic.  Needs the Kafka connector on the cluster's classpath."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    event_id = F.shiftleft(F.col("partition").cast("bigint"), 48).bitwiseOR(F.col("offset"))
    return r.load().select(event_id.alias("event_id"), F.col("value").cast("string").alias("value"))


def event_file_lines(spark: SparkSession, events_path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Log lines derived from a folder (or glob) of ``events`` Parquet files,
    as a file stream: each new file is new input."""
    r = spark.readStream.schema(EVENTS)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return ad_log_lines(r.parquet(events_path))


def line_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw log lines ``(event_id, value)`` from a folder of Parquet files
    (a topic dump); each new file is new input."""
    r = spark.readStream.schema(AD_LOG)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.parquet(path)


def parsed_clicks(lines: DataFrame) -> DataFrame:
    """ST1 on a stream: valid parsed clicks (``event_id`` kept when present)."""
    p = ads.parse_log_lines(lines)
    keep = [c for c in ["event_id"] if c in lines.columns]
    return p.where("valid").select(*keep, "ts_ms", "province", "city", "userid", "adid", "ts")


def _event_time(df: DataFrame, watermark: str | None) -> DataFrame:
    if "ts" not in df.columns:
        df = df.withColumn("ts", F.timestamp_millis(F.col("ts_ms")))
    return df.withWatermark("ts", watermark) if watermark else df


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep large stream state off-heap in RocksDB with changelog checkpoints,
    unless the session already names a provider other than the default."""
    current = spark.conf.get(_PROVIDER_KEY, None) or ""
    if current == "" or current.endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(_PROVIDER_KEY, ROCKSDB_PROVIDER)
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def _run(writer, trigger: dict, await_end: bool):
    q = writer.trigger(**trigger).start()
    if await_end:
        q.awaitTermination()
    return q


# --- stage A: blacklist + clean clicks ------------------------------------------

COUNTS_SCHEMA = T.StructType([T.StructField("userid", T.LongType()), T.StructField("adid", T.LongType()),
                              T.StructField("click_count", T.LongType()), T.StructField("date", T.StringType()),
                              T.StructField("bucket", T.IntegerType())])
BLACK_SCHEMA = T.StructType([T.StructField("userid", T.LongType()), T.StructField("bucket", T.IntegerType())])
#: User buckets of the count and blacklist tables: a folder of one day holds 1 / BUCKETS of its users.
BUCKETS = 64


def _bucket_number(spark: SparkSession, root: str, wanted: int) -> int:
    """The number of buckets that the tables were started with; ``wanted`` for new ones."""
    path = f"{root}/user_counts/_buckets"
    known = fs_read_text(spark, path)
    if known is None:
        fs_write_text(spark, path, str(int(wanted)))
    return int(known or wanted)


def user_bucket(buckets: int = BUCKETS):
    return F.expr(f"cast(pmod(xxhash64(userid), {int(buckets)}) as int)")


def _counts_log(spark: SparkSession, root: str, compact_every: int = 100) -> BatchLog:
    return BatchLog(spark, f"{root}/user_counts", [*ads.KEY_USER, "bucket"], "sum", COUNTS_SCHEMA, ["date", "bucket"], compact_every)


def _black_log(spark: SparkSession, root: str, threshold: int, compact_every: int = 100) -> BatchLog:
    """The users over ``threshold``: another threshold is another table."""
    return BatchLog(spark, f"{root}/blacklist/over-{int(threshold)}", ["userid", "bucket"], "first", BLACK_SCHEMA, ["bucket"], compact_every)


def touched(rows: DataFrame) -> tuple[list[str], list[int]]:
    """The days and the user buckets of a batch: as many values as there are folders at most."""
    r = rows.agg(F.sort_array(F.collect_set("date")), F.sort_array(F.collect_set("bucket"))).first()
    return list(r[0]), list(r[1])


def stored_counts(log: BatchLog, keys: DataFrame, before: int | None = None) -> DataFrame:
    """SNK6: the stored count of each (date, user, ad) of ``keys``; reads the folders of
    their days and user buckets only."""
    days, buckets = touched(keys)
    return log.lookup(keys, before, days, F.col("bucket").isin(buckets))


def _blacklisted(counts: DataFrame, threshold: int) -> DataFrame:
    return counts.where(F.col("click_count") > threshold).select("userid", "bucket").distinct()


def start_blacklist_stage(lines: DataFrame, root: str, threshold: int, checkpoint: str,
                          trigger: dict | None = None, await_end: bool = True, compact_every: int = 100,
                          retain_days: int | None = None, sink: TableSink | None = None, buckets: int = BUCKETS):
    """Stage A (ST2, FLT8, SNK2, SNK5, SNK6, rejects).

    A batch reads the blacklist and the stored counts of its own days and user buckets,
    whatever the stream has seen before.  ``compact_every`` bounds the number of small folders;
    a compaction rewrites only the days that have come since the last one.
    By default every total stays, so the result does not depend on when a
    compaction runs.  With ``retain_days`` set, totals older than that many event
    days are dropped when it runs (their blacklisted users stay): only for
    sources that never deliver older days.  A blacklist for a new threshold starts from
    the counts that are there.  ``buckets`` sizes new tables; existing ones keep theirs."""
    spark = lines.sparkSession
    buckets = _bucket_number(spark, root, buckets)
    clean_root, reject_root = f"{root}/clean", f"{root}/rejects"
    counts, black = _counts_log(spark, root, compact_every), _black_log(spark, root, threshold, compact_every)

    def batch(df: DataFrame, batch_id: int) -> None:
        if batch_id > 0 and not black.any() and counts.any():  # the first batch with this threshold
            black.publish(_blacklisted(counts.view(before=batch_id), threshold), batch_id - 1)
        parsed = ads.with_date(ads.parse_log_lines(df)).withColumn("bucket", user_bucket(buckets)).persist()
        try:
            sinks.publish_batch(parsed.where(~F.col("valid")).select("value"), reject_root, batch_id)
            valid = parsed.where("valid")
            listed = black.view(batch_id, touched(valid)[1])
            clean = ads.exclude_blacklisted(valid, listed)
            counts.publish(clean.groupBy(*ads.KEY_USER, "bucket").agg(F.count(F.lit(1)).alias("click_count")), batch_id)
            own = counts.batch(batch_id)
            total = sinks.upsert_add(stored_counts(counts, own, batch_id), own, [*ads.KEY_USER, "bucket"])
            black.publish(_blacklisted(total, threshold), batch_id)
            cols = [c for c in CLEAN_SCHEMA.fieldNames() if c in clean.columns]
            sinks.publish_batch(clean.select(*cols), clean_root, batch_id)
            if sink:
                sink.add("ad_user_click_count", own.select(*ads.KEY_USER, "click_count"), ads.KEY_USER, ["click_count"], batch_id)
                sink.insert_new("ad_blacklist", black.batch(batch_id).select("userid"), ["userid"], batch_id)
            if retain_days is not None:
                _forget_days(counts, int(retain_days))
        finally:
            parsed.unpersist()

    w = lines.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return _run(w, trigger or {"availableNow": True}, await_end)


def _forget_days(counts: BatchLog, retain_days: int) -> None:
    newest = max(counts.days(), default=None)
    if newest:
        day = datetime.strptime(newest, "%Y%m%d") - timedelta(days=retain_days)
        counts.forget(day.strftime("%Y%m%d"))


def blacklist_table(spark: SparkSession, root: str, threshold: int) -> DataFrame:
    """The current blacklist (SNK5); for a threshold that no run had, from all counts."""
    black = _black_log(spark, root, threshold)
    if black.any():
        return black.view().select("userid")
    return _blacklisted(_counts_log(spark, root).view(), threshold).select("userid").distinct()


def clean_click_stream(spark: SparkSession, root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(CLEAN_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.parquet(f"{root}/clean/batch_id=*")


# --- stage B: running totals, province top-3, minute trend ----------------------

CITY_SCHEMA = T.StructType([T.StructField("date", T.StringType()), T.StructField("province", T.StringType()),
                            T.StructField("city", T.StringType()), T.StructField("adid", T.LongType()),
                            T.StructField("click_count", T.LongType())])
TOP_SCHEMA = T.StructType([T.StructField("date", T.StringType()), T.StructField("province", T.StringType()),
                           T.StructField("adid", T.LongType()), T.StructField("click_count", T.LongType())])


def _city_log(spark: SparkSession, root: str, compact_every: int = 100) -> BatchLog:
    return BatchLog(spark, f"{root}/city_running", ads.KEY_CITY, "latest", CITY_SCHEMA, ["date"], compact_every)


def _top_log(spark: SparkSession, root: str, top_n: int, compact_every: int = 100) -> BatchLog:
    return BatchLog(spark, f"{root}/province_top/first-{int(top_n)}", ads.PROVINCE_GROUP, "group", TOP_SCHEMA, ["date"], compact_every)


def refreshed_top(old: DataFrame, changed: DataFrame, n: int) -> DataFrame:
    """WIN2 for the groups of ``changed`` (new totals of the ads that had clicks) from their
    ``old`` first ``n`` alone.  Totals only grow, so an ad that was not among the first and
    had no clicks cannot pass any of them."""
    groups = changed.select(*ads.PROVINCE_GROUP).distinct()
    stay = (old.join(groups, ads.PROVINCE_GROUP, "left_semi")
            .join(changed.select(*ads.KEY_PROVINCE), ads.KEY_PROVINCE, "left_anti"))
    return ads.province_top(changed.select(*ads.KEY_PROVINCE, "click_count").unionByName(stay.select(*ads.KEY_PROVINCE, "click_count")), n)


def start_city_running(clicks: DataFrame, root: str, checkpoint: str, watermark: str | None = None,
                       top_n: int = 3, trigger: dict | None = None, await_end: bool = True,
                       compact_every: int = 100, sink: TableSink | None = None):
    """ST3 + ST4: running totals per (day, province, city, ad) and per (day, province, ad) in
    one state store (update mode); each batch publishes the changed totals and, for the
    (date, province) groups it touched, the new top-``n`` ads (replace-group).

    By default state never expires, so a late click counts however late it is
    and the totals do not depend on batch cuts (state is one row per key, in
    RocksDB).  A ``watermark`` bounds the state and drops later clicks; set
    it only for sources whose delay it covers.  Both outputs are published on
    every attempt of a batch (each is idempotent), so a run that dies between
    them loses neither.  The top-``n`` refresh takes the groups' old top rows and the changed
    totals that come from the state: no total of an earlier batch is read again."""
    spark = clicks.sparkSession
    use_rocksdb_state(spark)
    running, tops = _city_log(spark, root, compact_every), _top_log(spark, root, top_n, compact_every) if top_n else None
    if watermark is None:
        _note_state(spark, root, "city_running", checkpoint)
    c = _event_time(clicks, watermark).withColumn("city", F.explode(F.array("city", F.lit(None).cast("string"))))
    agg = (c.groupBy(F.window("ts", "1 day").alias("day"), "province", "city", "adid")
           .agg(F.count(F.lit(1)).alias("click_count"))
           .select(F.date_format("day.start", "yyyyMMdd").alias("date"), "province", "city", "adid",
                   "click_count"))

    def batch(df: DataFrame, batch_id: int) -> None:
        df = df.persist()  # used by both outputs
        try:
            if df.isEmpty():  # e.g. the no-data batch that only advances the watermark
                return
            running.publish(df.where("city is not null"), batch_id)
            if sink:
                sink.replace("ad_stat", running.batch(batch_id).select(*CITY_SCHEMA.fieldNames()), ads.KEY_CITY, batch_id)
            if not top_n:
                return
            if not tops.any() and batch_id > 0:  # the first batch with this n
                past = running.view(before=batch_id)
                tops.publish(ads.province_top(ads.province_counts(past), top_n), batch_id - 1)
            changed = df.where("city is null")
            days = list(changed.agg(F.collect_set("date")).first()[0])
            tops.publish(refreshed_top(tops.view(batch_id, days), changed, top_n), batch_id)
            if sink:
                sink.replace_group("ad_province_top3", tops.batch(batch_id).select(*TOP_SCHEMA.fieldNames()), ads.PROVINCE_GROUP, batch_id)
        finally:
            df.unpersist()

    w = agg.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint)
    return _run(w, trigger or {"availableNow": True}, await_end)


def _note_state(spark: SparkSession, root: str, name: str, checkpoint: str) -> None:
    """Remember where the state of an output that never expires lies."""
    fs_write_text(spark, f"{root}/{name}/_state", checkpoint)


def _state(spark: SparkSession, root: str, name: str, operator: int = 0) -> DataFrame | None:
    """The keyed state of a query as of its last batch, where it is noted."""
    checkpoint = fs_read_text(spark, f"{root}/{name}/_state")
    if checkpoint is None or not fs_exists(spark, f"{checkpoint}/state/{operator}"):
        return None
    return spark.read.format("statestore").option("operatorId", operator).load(checkpoint)


def city_running_table(spark: SparkSession, root: str) -> DataFrame:
    """Current running totals: the rows of the state store; with a watermark (state
    leaves the store) the newest published total of each key."""
    state = _state(spark, root, "city_running")
    if state is None:
        return _city_log(spark, root).view().select(*ads.KEY_CITY, F.col("click_count").cast("bigint"))
    return state.where("key.city is not null").select(
        F.date_format(_window_start(state), "yyyyMMdd").alias("date"), "key.province", "key.city", "key.adid",
        F.col("value.count").alias("click_count"))


def _window_start(state: DataFrame):
    """The window of a state key, whatever the plan named it."""
    name = next(f.name for f in state.schema["key"].dataType.fields if isinstance(f.dataType, T.StructType))
    return F.col("key")[name]["start"]


def province_top_table(spark: SparkSession, root: str, top_n: int = 3) -> DataFrame:
    """Current province top-n: per (date, province) the rows of the newest
    batch that refreshed the group (replace-group semantics)."""
    return _top_log(spark, root, top_n).view().select("date", "province", "adid", F.col("click_count").cast("bigint"))


MINUTE_KEYS = ["date", "hour", "minute", "adid"]
MINUTE_SCHEMA = T.StructType([T.StructField("date", T.StringType()), T.StructField("hour", T.StringType()),
                              T.StructField("minute", T.StringType()), T.StructField("adid", T.LongType()),
                              T.StructField("click_count", T.LongType())])


def _minute_log(spark: SparkSession, root: str, compact_every: int = 100) -> BatchLog:
    return BatchLog(spark, f"{root}/minute_trend", MINUTE_KEYS, "latest", MINUTE_SCHEMA, ["date"], compact_every)


def start_minute_trend(clicks: DataFrame, root: str, checkpoint: str, watermark: str | None = None,
                       trigger: dict | None = None, await_end: bool = True, compact_every: int = 100,
                       sink: TableSink | None = None):
    """ST5a: per-(minute, ad) counts in the state store (update mode).  By default
    state never expires and late clicks count; with a ``watermark`` later rows
    are dropped and reported in the query progress
    (``numRowsDroppedByWatermark``); ``start_trend_with_late`` keeps them."""
    spark = clicks.sparkSession
    use_rocksdb_state(spark)
    c = _event_time(clicks, watermark)
    agg = c.groupBy(ads.minute_window(F.col("ts")).alias("w"), "adid").agg(F.count(F.lit(1)).alias("click_count"))
    out = agg.select(*_minute_of("w.start"), "adid", "click_count")

    log = _minute_log(spark, root, compact_every)

    def batch(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            if not df.isEmpty():
                log.publish(df, batch_id)
                if sink:
                    sink.replace("ad_click_trend", log.batch(batch_id).select(*MINUTE_SCHEMA.fieldNames()), MINUTE_KEYS, batch_id)
        finally:
            df.unpersist()

    w = out.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint)
    return _run(w, trigger or {"availableNow": True}, await_end)


def _minute_of(start: str) -> list:
    return [F.date_format(start, p).alias(n) for n, p in (("date", "yyyyMMdd"), ("hour", "HH"), ("minute", "mm"))]


def minute_trend_table(spark: SparkSession, root: str) -> DataFrame:
    """Current per-minute counts: the newest published count of each key, and the late clicks
    beside them where a stream keeps those apart."""
    seen = _minute_log(spark, root).view().select(*MINUTE_KEYS, F.col("click_count").cast("bigint"))
    late = _late_log(spark, root)
    return sinks.upsert_add(seen, late.view(), MINUTE_KEYS) if late.any() else seen


def sliding_hour_table(spark: SparkSession, root: str, window_minutes: int = 60) -> DataFrame:
    """ST5b on the stream: 60-minute windows sliding by one minute, derived
    from the per-minute state output (state stays one row per minute and
    ad, not one per window)."""
    m = minute_trend_table(spark, root)
    ts = F.to_timestamp(F.concat_ws("", "date", "hour", "minute"), "yyyyMMddHHmm")
    return ads.sliding_from_minutes(m.select(ts.alias("m"), "adid", F.col("click_count").alias("c")),
                                    window_minutes)


# --- trends with bounded state that lose no late click ----------------------------

HOUR_KEYS = ["date", "hour", "adid"]
HOUR_SCHEMA = T.StructType([f for f in MINUTE_SCHEMA.fields if f.name != "minute"])
_MAX_SCHEMA = T.StructType([T.StructField("newest", T.TimestampType())])


def _late_log(spark: SparkSession, root: str, compact_every: int = 100) -> BatchLog:
    return BatchLog(spark, f"{root}/late_minutes", MINUTE_KEYS, "sum", MINUTE_SCHEMA, ["date"], compact_every)


def _hour_log(spark: SparkSession, root: str, compact_every: int = 100) -> BatchLog:
    return BatchLog(spark, f"{root}/hour_trend", HOUR_KEYS, "sum", HOUR_SCHEMA, ["date"], compact_every)


def _start_late_split(clicks: DataFrame, root: str, checkpoint: str, delay: str, trigger: dict, await_end: bool, compact_every: int):
    """Clicks of minutes that a watermark of ``delay`` has passed, by the newest click of all
    earlier batches, are counted into the late output; the others go on."""
    spark = clicks.sparkSession
    late = _late_log(spark, root, compact_every)
    newest = BatchLog(spark, f"{root}/newest", [], "latest", _MAX_SCHEMA, (), 0)

    def batch(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            seen = newest.last(batch_id)
            passed = seen.select(F.expr(f"newest - interval {delay}")).scalar()
            end = F.date_trunc("minute", "ts") + F.expr("interval 1 minute")
            is_late = F.coalesce(end <= passed, F.lit(False))
            late.publish(df.where(is_late).groupBy(*_minute_of("ts"), "adid").agg(F.count(F.lit(1)).alias("click_count")), batch_id)
            sinks.publish_batch(df.where(~is_late).select(*[c for c in CLEAN_SCHEMA.fieldNames() if c in df.columns]), f"{root}/ontime", batch_id)
            now = df.agg(F.max("ts").alias("newest")).unionByName(seen).agg(F.max("newest").alias("newest"))
            newest.publish(now, batch_id)
            newest.drop_batches(batch_id - 10)  # a replay asks for the batch before it at most
        finally:
            df.unpersist()

    w = _event_time(clicks, None).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return _run(w, trigger, await_end)


def start_trend_with_late(clicks: DataFrame, root: str, checkpoint: str, delay: str = "1 hour", trigger: dict | None = None,
                          await_end: bool = True, compact_every: int = 100, sink: TableSink | None = None) -> list:
    """ST5a with state that a watermark of ``delay`` bounds, and no click lost.

    Three queries: the split into late and other clicks, the per-minute counts of the others
    (update mode), and chained event-time aggregates over them (append mode): minutes, then hours by
    ``window_time``.  The followers read whole batches of the split, so their watermark never
    passes the split's, and they drop nothing; bound a batch at the source of ``clicks``."""
    spark = clicks.sparkSession
    use_rocksdb_state(spark)
    trigger = trigger or {"availableNow": True}
    fs_mkdirs(spark, f"{root}/ontime")
    q = [_start_late_split(clicks, root, f"{checkpoint}/split", delay, trigger, await_end, compact_every)]

    def ontime() -> DataFrame:
        return spark.readStream.schema(CLEAN_SCHEMA).parquet(f"{root}/ontime/batch_id=*")

    q.append(start_minute_trend(ontime(), root, f"{checkpoint}/minute", delay, trigger, await_end, compact_every, sink))
    minutes = _event_time(ontime(), delay).groupBy(ads.minute_window(F.col("ts")).alias("minute"), "adid").agg(F.count(F.lit(1)).alias("c"))
    hours = (minutes.groupBy(F.window(F.window_time("minute"), "1 hour").alias("hour"), "adid").agg(F.sum("c").alias("click_count"))
             .select(F.date_format("hour.start", "yyyyMMdd").alias("date"), F.date_format("hour.start", "HH").alias("hour"), "adid", "click_count"))
    log = _hour_log(spark, root, compact_every)
    _note_state(spark, root, "hour_trend", f"{checkpoint}/hour")
    w = (hours.writeStream.outputMode("append").foreachBatch(lambda df, batch_id: log.publish(df, batch_id) and None)
         .option("checkpointLocation", f"{checkpoint}/hour"))
    return [*q, _run(w, trigger, await_end)]


def hour_trend_table(spark: SparkSession, root: str) -> DataFrame:
    """Clicks per (date, hour, ad) of ``start_trend_with_late``: hours that are closed, what the
    state holds of open hours and open minutes, and the late clicks."""
    parts = [_hour_log(spark, root).view(), _late_log(spark, root).view().drop("minute")]
    for operator in (0, 1):
        state = _state(spark, root, "hour_trend", operator)
        if state is not None:
            value = state.schema["value"].dataType.fieldNames()[0]
            parts.append(state.select(F.date_format(_window_start(state), "yyyyMMdd").alias("date"),
                                      F.date_format(_window_start(state), "HH").alias("hour"), "key.adid",
                                      F.col("value")[value].alias("click_count")))
    rows = parts[0].select(*HOUR_SCHEMA.fieldNames())
    for p in parts[1:]:
        rows = rows.unionByName(p.select(*HOUR_SCHEMA.fieldNames()))
    return rows.groupBy(*HOUR_KEYS).agg(F.sum("click_count").cast("bigint").alias("click_count"))


def start_parse_to_files(lines: DataFrame, out: str, checkpoint: str, trigger: dict | None = None,
                         await_end: bool = True):
    """ST1 as a stateless stream into a Parquet file sink (exactly-once via
    the sink's metadata log): ``valid=true`` holds the clicks, ``valid=false`` the
    rejected lines (``value``), so that no line is lost."""
    parsed = ads.parse_log_lines(lines).drop("ts").withColumn("value", F.when(~F.col("valid"), F.col("value")))
    w = (parsed.writeStream.format("parquet").partitionBy("valid").option("path", out)
         .option("checkpointLocation", checkpoint))
    return _run(w, trigger or {"availableNow": True}, await_end)


# --- whole job ----------------------------------------------------------------

def run_ads_job(spark: SparkSession, lines: DataFrame, threshold: int = 100, top_n: int = 3,
                root: str | None = None, trigger: dict | None = None, await_end: bool = True,
                max_files_per_trigger: int | None = None, compact_every: int = 100, retain_days: int | None = None,
                watermark: str | None = None, late_delay: str | None = None, sink: TableSink | None = None,
                buckets: int = BUCKETS) -> dict:
    """JOB6: stage A then stage B (city running + top-n, minute trend).

    With the default ``availableNow`` trigger and ``await_end`` each stage
    drains its input and stops, in order.  With ``await_end=False`` (e.g. a
    ``processingTime`` trigger) the queries run side by side: stage B
    picks up each batch folder stage A publishes, ``max_files_per_trigger`` files
    at a time when set.  ``watermark`` bounds the running totals' state and drops later clicks;
    ``late_delay`` bounds the trend's state and keeps them (``start_trend_with_late``).
    ``sink`` gets the five result tables as well.  Returns the output root and the query handles."""
    root = root or run_dir(spark, "ads")
    ck = f"{root}/_checkpoints"
    fs_mkdirs(spark, f"{root}/clean")
    more = {"trigger": trigger, "await_end": await_end, "compact_every": compact_every, "sink": sink}
    qs = [start_blacklist_stage(lines, root, threshold, f"{ck}/stage_a", retain_days=retain_days, buckets=buckets, **more)]
    clean = lambda: clean_click_stream(spark, root, max_files_per_trigger)
    qs.append(start_city_running(clean(), root, f"{ck}/city", watermark, top_n, **more))
    if late_delay:
        qs += start_trend_with_late(clean(), root, f"{ck}/trend", late_delay, **more)
    else:
        qs.append(start_minute_trend(clean(), root, f"{ck}/minute", watermark, **more))
    return {"root": root, "queries": qs}
