"""JOB5 written as SQL text over temporary views, with the SQL functions
registered - the same plan shape as the DataFrame form in ``operators.area``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickscope.functions.exprs import area_level
from clickscope.functions.sql_functions import register_sql_functions
from clickscope.params import TaskParams
from clickscope.sources.fixtures import Fixture


def area_top3_sql(spark: SparkSession, sf_dir: str, params: TaskParams) -> DataFrame:
    fx = Fixture(spark, sf_dir)
    register_sql_functions(spark)
    fx.visit_log().createOrReplaceTempView("user_visit_action")
    fx.products().createOrReplaceTempView("product_info")
    fx.cities().createOrReplaceTempView("city_info")
    date_filter, args = "", {"n": params.top_products}
    if params.start_date is not None and params.end_date is not None:
        date_filter = "AND date >= :start AND date <= :end"
        args |= {"start": params.start_date, "end": params.end_date}
    return spark.sql(f"""
        WITH clicks AS (
          SELECT city_id, click_product_id AS pid FROM user_visit_action
          WHERE click_product_id != -1 {date_filter}),
        base AS (
          SELECT c.area, k.pid, concat_long_string(c.city_id, c.city_name, ':') AS city_info
          FROM clicks k JOIN city_info c ON k.city_id = c.city_id),
        counts AS (
          SELECT area, pid, count(*) AS click_count,
                 listagg(DISTINCT city_info, ',') WITHIN GROUP (ORDER BY city_info) AS city_infos
          FROM base GROUP BY area, pid),
        info AS (
          SELECT a.area, a.pid, a.click_count, a.city_infos, p.product_name,
                 if(get_json_field(p.extend_info, 'product_status') = '0', 'Self', 'Third Party') AS product_status
          FROM counts a JOIN product_info p ON a.pid = p.product_id),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY area ORDER BY click_count DESC, pid) AS rn FROM info)
        SELECT area, pid, city_infos, click_count, product_name, product_status
        FROM ranked WHERE rn <= :n""", args).select(
        "area", area_level("area").alias("area_level"), "pid", "city_infos", "click_count", "product_name", "product_status")
