"""End-to-end runs of the batch jobs: compute every output of a job, tag it
with the run's task id and write it to a sink (Parquet folder or JDBC).

The filtered sessions feed five outputs of the session report; they are
written once under ``spark.checkpoint.dir`` (lineage cut, survives lost
executors), so the visit log is summarised once per run, not once per
output; the statistics are observed while they are written."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickscope.operators import area, funnel, sinks
from clickscope.params import TaskParams
from clickscope.plans.jobs import SessionReport
from clickscope.sources.tables import actions_in_range, area_clicks

Writer = Callable[[DataFrame, str], None]


def parquet_writer(root: str) -> Writer:
    """Append each result table under ``root/<table>``."""
    def write(df: DataFrame, table: str) -> None:
        df.write.mode("append").parquet(f"{root.rstrip('/')}/{table}")
    return write


def jdbc_writer(url: str, properties: dict | None = None) -> Writer:
    def write(df: DataFrame, table: str) -> None:
        sinks.jdbc_append(df, url, table, properties)
    return write


def _tag(df: DataFrame, task_id: str) -> DataFrame:
    return df.select(F.lit(task_id).alias("taskid"), *df.columns)


def run_session_report(spark: SparkSession, visit_log: DataFrame, users: DataFrame, params: TaskParams,
                       write: Writer, task_id: str | None = None) -> str:
    """JOB1: session statistics, stratified sample (+ its action rows), top
    categories and top sessions per category."""
    task_id = task_id or str(uuid.uuid4())
    report = SessionReport(actions_in_range(visit_log, params), users, params).written()
    write(_tag(report.stats(), task_id), "session_aggr_stat")
    write(_tag(report.sample(), task_id), "session_random_extract")
    write(_tag(report.sample_detail(), task_id), "session_detail")
    write(_tag(report.top_categories(), task_id), "top10_category")
    write(_tag(report.top_sessions(), task_id), "top10_session")
    return task_id


def run_page_conversion(spark: SparkSession, visit_log: DataFrame, params: TaskParams, write: Writer,
                        task_id: str | None = None, rounded: bool = True) -> str:
    """JOB2 / JOB3 / JOB4: the funnel as rows and as the one-string form."""
    task_id = task_id or str(uuid.uuid4())
    acts = actions_in_range(visit_log, params)
    write(_tag(funnel.funnel_conversion(acts, params.flow, rounded), task_id),
          "page_split_convert_rate")
    write(_tag(funnel.funnel_string(acts, params.flow), task_id), "page_convert_rate")
    return task_id


def run_area_top3(spark: SparkSession, visit_log: DataFrame, products: DataFrame, cities: DataFrame,
                  params: TaskParams, write: Writer, task_id: str | None = None) -> str:
    """JOB5."""
    task_id = task_id or str(uuid.uuid4())
    base = area.area_base(area_clicks(visit_log, params), cities)
    info = area.area_product_info(area.area_product_clicks(base), products)
    write(_tag(area.area_top3(info, params.top_products), task_id), "area_top3_product")
    return task_id
