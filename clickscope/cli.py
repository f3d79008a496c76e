"""Command line entry points for the jobs (spark-submit friendly).

    python -m clickscope.cli session-report --visit-log T --users T --params '{...}' --out PATH
    python -m clickscope.cli page-conversion --visit-log T --params '{...}' --out PATH
    python -m clickscope.cli area-top3 --visit-log T --products T --params '{...}' --out PATH
    python -m clickscope.cli ads-stream --lines PATH | --kafka SERVERS --topic T --out PATH [--threshold 100]

Tables are catalog names or Parquet paths; ``--params`` is the JSON task
parameter object (startDate, endDate, startAge, ..., targetPageFlow);
``--out`` is a Parquet folder or a ``jdbc:`` URL (``--jdbc-driver`` names the
driver class).  The master and ``spark.checkpoint.dir`` come from the
cluster / spark-submit."""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import replace

from clickscope.operators.database_sink import DuplicateKeyDialect, JdbcSink
from clickscope.params import TaskParams, params_from_properties
from clickscope.plans import reports
from clickscope.schemas import VISIT_LOG
from clickscope.session import get_spark
from clickscope.sources.fixtures import cities
from clickscope.sources.tables import load
from clickscope.streaming import ads_stream


def _writer(out: str, driver: str | None):
    if out.startswith("jdbc:"):
        return reports.jdbc_writer(out, {"driver": driver} if driver else {})
    return reports.parquet_writer(out)


#: A micro-batch is bounded unless a flag says otherwise: a backlog is worked off piece by piece.
MAX_FILES, MAX_OFFSETS = 1000, 5_000_000
#: Flags of the batch jobs that override the task parameters.
SETTINGS = ("sample_size", "sample_seed", "top_categories", "top_sessions", "top_products")


def _params(text: str | None) -> TaskParams:
    return TaskParams.from_json(json.loads(text)) if text else TaskParams()


def main(argv: list[str] | None = None, spark=None) -> str:
    ap = argparse.ArgumentParser(prog="clickscope")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("session-report", "page-conversion", "area-top3"):
        p = sub.add_parser(name)
        p.add_argument("--visit-log", required=True)
        p.add_argument("--users")
        p.add_argument("--products")
        p.add_argument("--cities", help="area-top3: table of (city_id, city_name, area); the fixed ten when not given")
        p.add_argument("--params", help="JSON task parameter object")
        p.add_argument("--params-file", help="properties file whose task.params.json holds the parameters")
        p.add_argument("--task-id")
        p.add_argument("--out", required=True)
        p.add_argument("--jdbc-driver")
        for flag in SETTINGS:
            p.add_argument("--" + flag.replace("_", "-"), type=str if flag == "sample_seed" else int)
        p.add_argument("--raw-rate", action="store_true", help="page-conversion: rates that are not rounded")
    s = sub.add_parser("ads-stream")
    s.add_argument("--lines", help="folder of Parquet files with a `value` text column")
    s.add_argument("--kafka")
    s.add_argument("--topic")
    s.add_argument("--out", required=True)
    s.add_argument("--threshold", type=int, default=100)
    s.add_argument("--top", type=int, default=3)
    s.add_argument("--max-files-per-trigger", type=int, default=MAX_FILES, help="files of one micro-batch")
    s.add_argument("--starting", default="latest", help="Kafka starting offsets")
    s.add_argument("--max-offsets-per-trigger", type=int, default=MAX_OFFSETS, help="Kafka records of one micro-batch")
    s.add_argument("--compact-every", type=int, default=100, help="micro-batches between compactions")
    s.add_argument("--retain-days", type=int, help="event days whose user counts are kept (all when not given)")
    s.add_argument("--watermark", help="delay after which running totals are closed and later clicks dropped, e.g. '2 days'")
    s.add_argument("--late-delay", help="delay after which trend minutes are closed; later clicks go to the late output")
    s.add_argument("--jdbc", help="jdbc: URL of a database that gets the result tables too (created when missing)")
    s.add_argument("--jdbc-driver", help="driver class of --jdbc")
    s.add_argument("--on-duplicate-key", action="store_true", help="the database upserts by ON DUPLICATE KEY, not by MERGE")
    s.add_argument("--trigger", default="5 seconds", help="processing-time interval, or 'once' to drain and stop")
    a = ap.parse_args(argv)
    spark = spark or get_spark(app_name=f"clickscope-{a.cmd}")

    if a.cmd == "ads-stream":
        limit = {"maxOffsetsPerTrigger": a.max_offsets_per_trigger}
        sink = None
        if a.jdbc:
            sink = JdbcSink(spark, a.jdbc, a.jdbc_driver, dialect=DuplicateKeyDialect() if a.on_duplicate_key else None)
            sink.create_tables()
        lines = (ads_stream.kafka_lines(spark, a.kafka, a.topic, a.starting, limit) if a.kafka
                 else ads_stream.line_files(spark, a.lines, a.max_files_per_trigger))
        once = a.trigger == "once"
        trigger = {"availableNow": True} if once else {"processingTime": a.trigger}
        job = ads_stream.run_ads_job(spark, lines, a.threshold, a.top, a.out, trigger, await_end=once,
                                     max_files_per_trigger=a.max_files_per_trigger, compact_every=a.compact_every,
                                     retain_days=a.retain_days, watermark=a.watermark, late_delay=a.late_delay, sink=sink)
        if not once:
            for q in job["queries"]:
                q.awaitTermination()
        return job["root"]

    params = params_from_properties(a.params_file) if a.params_file else _params(a.params)
    params = replace(params, **{k: getattr(a, k) for k in SETTINGS if getattr(a, k) is not None})
    # paths: the visit-log schema keeps a `date` partition column a string
    visit_log = load(spark, a.visit_log, schema=VISIT_LOG).select(*VISIT_LOG.fieldNames())
    write = _writer(a.out, a.jdbc_driver)
    if a.cmd == "session-report":
        return reports.run_session_report(spark, visit_log, load(spark, a.users), params, write, a.task_id)
    if a.cmd == "page-conversion":
        return reports.run_page_conversion(spark, visit_log, params, write, a.task_id, rounded=not a.raw_rate)
    return reports.run_area_top3(spark, visit_log, load(spark, a.products),
                                 load(spark, a.cities) if a.cities else cities(spark), params, write, a.task_id)


if __name__ == "__main__":
    print(main(sys.argv[1:]))
