"""Composite jobs: ``SessionReport`` returns lazy DataFrames sharing one plan prefix; its
``written()`` form computes that prefix once for several outputs."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession

from clickscope.operators import area, categories, funnel, sampling, sessions
from clickscope.params import TaskParams
from clickscope.session import run_dir
from clickscope.sources.fixtures import Fixture
from clickscope.sources.tables import actions_in_range, area_clicks


@dataclass
class SessionReport:
    """JOB1: SRC1 -> AGG1 -> JON1 -> FLT4 -> {AGG3, SMP2, JON2 -> TOP1 -> TOP3}."""

    actions: DataFrame
    users: DataFrame
    params: TaskParams

    @property
    def summary(self) -> DataFrame:
        return sessions.session_summary(self.actions)

    @property
    def full(self) -> DataFrame:
        return sessions.with_users(self.summary, self.users)

    @property
    def filtered(self) -> DataFrame:
        return sessions.filter_sessions(self.full, self.params)

    @property
    def filtered_actions(self) -> DataFrame:
        return sessions.actions_of_sessions(self.actions, self.filtered)

    def stats(self) -> DataFrame:
        return sessions.session_stats(self.filtered)

    def sample(self) -> DataFrame:
        return sampling.session_sample(self.filtered, self.params.sample_size, self.params.sample_seed)

    def top_categories(self) -> DataFrame:
        return categories.top_categories(self.filtered_actions, self.params.top_categories)

    def top_sessions(self) -> DataFrame:
        return categories.top_sessions_per_category(self.filtered_actions, self.params.top_categories,
                                                    self.params.top_sessions)

    def written(self) -> WrittenReport:
        """The report with its filtered sessions written to the shared folder, once."""
        return WrittenReport(self)


class WrittenReport:
    """The outputs of JOB1 over intermediate tables: the filtered sessions, and the category
    counts of their actions, are each computed by one job and then read.

    The job that writes the sessions observes the bucket counts as the rows pass by
    (``DataFrame.observe``), so the statistics need no pass of their own.  They stand right
    above the write, in the job's last stage, where a task that is run again counts once."""

    def __init__(self, report: SessionReport):
        self.actions, self.params = report.actions, report.params
        self.spark = report.actions.sparkSession
        totals = Observation()
        observed = report.filtered.observe(totals, *sessions.bucket_totals())
        self.filtered = self._write(observed, "report-sessions")
        row = totals.get
        names = list(row)
        self._totals = self.spark.createDataFrame([tuple(int(row[n]) for n in names)], ", ".join(f"`{n}` bigint" for n in names))

    def _write(self, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
        path = run_dir(self.spark, name)
        (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def stats(self) -> DataFrame:
        return sessions.stats_of_totals(self._totals)

    def bucket_counts(self) -> DataFrame:
        return sessions.counts_of_totals(self._totals)

    def quota(self) -> DataFrame:
        return sampling.sample_quota(self.filtered, self.params.sample_size)

    def sample(self) -> DataFrame:
        return sampling.session_sample(self.filtered, self.params.sample_size, self.params.sample_seed)

    def sample_detail(self) -> DataFrame:
        return sampling.session_sample_detail(self.actions, self.sample(), self.params.sample_size)

    @cached_property
    def _counts(self) -> DataFrame:
        own = sessions.actions_of_sessions(self.actions, self.filtered)
        return self._write(categories.category_session_counts(own), "report-categories", "level")

    def top_categories(self) -> DataFrame:
        return categories.first_categories(self._counts.where("level = 1"), self.params.top_categories)

    def session_category_clicks(self) -> DataFrame:
        return categories.category_session_clicks(self._counts, self.params.top_categories)

    def top_sessions(self) -> DataFrame:
        return categories.first_sessions(self.session_category_clicks(), self.params.top_sessions)


def session_report(spark: SparkSession, sf_dir: str, params: TaskParams) -> SessionReport:
    fx = Fixture(spark, sf_dir)
    return SessionReport(actions_in_range(fx.visit_log(), params), fx.users(), params)


def page_conversion(spark: SparkSession, sf_dir: str, params: TaskParams, rounded: bool = True) -> DataFrame:
    """JOB2 / JOB3."""
    acts = actions_in_range(Fixture(spark, sf_dir).visit_log(), params)
    return funnel.funnel_conversion(acts, params.flow, rounded)


def area_top3_job(spark: SparkSession, sf_dir: str, params: TaskParams) -> DataFrame:
    """JOB5: SRC2 -> JON4 -> AGG9 -> JON5 -> PRJ2 -> WIN1 -> PRJ1."""
    fx = Fixture(spark, sf_dir)
    base = area.area_base(area_clicks(fx.visit_log(), params), fx.cities())
    info = area.area_product_info(area.area_product_clicks(base), fx.products())
    return area.area_top3(info, params.top_products)


__all__ = ["SessionReport", "WrittenReport", "session_report", "page_conversion", "area_top3_job"]
