"""SQL-callable forms of the registered functions (UDF1-UDF3).

``concat_long_string`` and ``get_json_field`` become Spark SQL functions
defined by an expression (``CREATE TEMPORARY FUNCTION ... RETURN``), so SQL
text can call them and Catalyst still sees built-in expressions - no Python
runs per row.  The distinct-concat aggregate is the built-in
``listagg(DISTINCT x, sep) WITHIN GROUP (ORDER BY x)`` (or the
``group_concat_distinct`` Column helper)."""

from __future__ import annotations

from pyspark.sql import SparkSession

SQL_FUNCTIONS = {
    "concat_long_string": (
        "CREATE OR REPLACE TEMPORARY FUNCTION concat_long_string(v1 BIGINT, v2 STRING, split STRING) "
        "RETURNS STRING RETURN concat(CAST(v1 AS STRING), split, v2)"),
    "get_json_field": (
        "CREATE OR REPLACE TEMPORARY FUNCTION get_json_field(json STRING, field STRING) "
        "RETURNS STRING RETURN get_json_object(json, concat('$[''', field, ''']'))"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    for ddl in SQL_FUNCTIONS.values():
        spark.sql(ddl)
    return list(SQL_FUNCTIONS)
