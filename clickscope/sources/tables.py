"""Scans of the visit log and its projections (SRC1, SRC2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscope.params import TaskParams


def actions_in_range(visit_log: DataFrame, params: TaskParams) -> DataFrame:
    """SRC1: actions whose ``date`` lies in the inclusive parameter range.

    A plain comparison on the scanned column, so on a Parquet table (or a
    table partitioned by ``date``) Spark pushes it into the scan."""
    cond = F.lit(True)
    if params.start_date is not None:
        cond = cond & (F.col("date") >= F.lit(params.start_date))
    if params.end_date is not None:
        cond = cond & (F.col("date") <= F.lit(params.end_date))
    return visit_log.where(cond)


def area_clicks(visit_log: DataFrame, params: TaskParams) -> DataFrame:
    """SRC2: ``(city_id, click_product_id)`` of click actions in the range."""
    return (actions_in_range(visit_log, params)
            .where(F.col("click_product_id") != -1)
            .select("city_id", "click_product_id"))


def load(spark, source: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """A table by catalog name (``db.table`` / ``table``) or a path.

    Catalog tables go through ``spark.table`` so partition pruning and
    pushdown come from the catalog's layout; paths are read with ``fmt``."""
    if "/" not in source and ":" not in source:
        return spark.table(source)
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    return r.load(source)
