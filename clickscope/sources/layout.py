"""A visit log laid out by session, for jobs that group, join and order by session.

The table is bucketed by ``session_id`` (and partitioned by ``date``, so date
ranges still prune): the session summary (AGG1), the actions of given sessions
(JON2) and the page successor (WIN4) find the rows of a session in one
bucket and need no exchange of the log.

A bucket is read by one task, so a session with a large share of all rows would make
that task the job.  ``save_by_session`` measures the largest session first and
refuses such a log; the plain layout splits sessions of any size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickscope.schemas import VISIT_LOG

#: Largest session allowed, as a multiple of the rows of an average bucket.
MOST = 1.0


class UnevenSessions(ValueError):
    """One session is too large for a bucket of its own size class."""


def save_by_session(visit_log: DataFrame, table: str, buckets: int, most: float = MOST) -> None:
    """Write ``visit_log`` as the catalog table ``table`` in ``buckets`` session buckets;
    an existing table is replaced.  Choose ``buckets`` so that one is a task's work."""
    sizes = visit_log.groupBy("session_id").agg(F.count(F.lit(1)).alias("n")).agg(
        F.max("n").alias("largest"), F.sum("n").alias("rows")).first()
    if sizes["rows"] and sizes["largest"] > max(1.0, most * sizes["rows"] / int(buckets)):
        raise UnevenSessions(f"the largest session has {sizes['largest']} of {sizes['rows']} rows: more than {most:g} of {buckets} buckets")
    # one writer for each bucket: a day's rows of a bucket are one sorted file
    (visit_log.repartition(int(buckets), "session_id").write.mode("overwrite")
     .partitionBy("date").bucketBy(int(buckets), "session_id").sortBy("session_id", "action_time").saveAsTable(table))


def load_by_session(spark: SparkSession, table: str) -> DataFrame:
    """The table, its columns in the order of the visit log."""
    return spark.table(table).select(*VISIT_LOG.fieldNames())
