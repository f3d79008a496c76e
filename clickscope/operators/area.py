"""Area top-3 products (SRC5, JON4, JON5, AGG9, AGG10, PRJ1, PRJ2, WIN1, JOB5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickscope.functions.exprs import area_level, concat_long_string, group_concat_distinct, product_status


def area_base(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """JON4: clicks joined with the city dimension (any caller's table: it is
    broadcast when its measured size allows it)."""
    return (clicks.join(cities, "city_id", "inner")
            .select("city_id", "city_name", "area", F.col("click_product_id").alias("pid")))


def area_product_clicks(base: DataFrame) -> DataFrame:
    """AGG9 + AGG10: clicks per (area, product) and the distinct, sorted
    ``city_id:city_name`` list of the clicking cities."""
    return base.groupBy("area", "pid").agg(
        F.count(F.lit(1)).alias("click_count"),
        group_concat_distinct(concat_long_string("city_id", "city_name", ":")).alias("city_infos"),
    )


def area_city_infos(base: DataFrame) -> DataFrame:
    """AGG10 on its own: distinct ``city_id:city_name`` per area."""
    return base.groupBy("area").agg(
        group_concat_distinct(concat_long_string("city_id", "city_name", ":")).alias("city_infos"))


def area_product_info(counts: DataFrame, products: DataFrame) -> DataFrame:
    """JON5 + PRJ2: attach product name and self / third-party status
    (unknown products drop, as in an inner join)."""
    p = products.select(F.col("product_id").alias("pid"), "product_name",
                        product_status("extend_info").alias("product_status"))
    return counts.join(p, "pid", "inner").select("area", "pid", "click_count", "city_infos",
                                                 "product_name", "product_status")


def area_top3(info: DataFrame, n: int = 3) -> DataFrame:
    """WIN1 + PRJ1: per area the ``n`` products with most clicks (ties by pid),
    labelled with the area level.  ``row_number() <= n`` becomes a
    WindowGroupLimit: each map task keeps its local top ``n`` per area before
    the shuffle, so an area with many products is never sorted in one task."""
    w = Window.partitionBy("area").orderBy(F.desc("click_count"), F.asc("pid"))
    return (info.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
            .select("area", area_level("area").alias("area_level"), "pid", "city_infos", "click_count",
                    "product_name", "product_status"))
