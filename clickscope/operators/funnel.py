"""Page funnel: consecutive page pairs and step-by-step conversion
(WIN4, FLT7, AGG11, AGG12, WIN5, JOB2-JOB4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickscope.functions.exprs import half_up_ratio, raw_ratio
from clickscope.operators.ordered import next_in_group


def flow_steps(spark: SparkSession, flow: Sequence[int]) -> DataFrame:
    """The target flow as rows ``(step, pair, prev_pair)``; step 1's
    denominator is the start page's views, keyed ``'pv'``.  Its size is the
    flow length, a parameter, so joins against it are broadcast."""
    rows = []
    for i in range(1, len(flow)):
        pair = f"{flow[i - 1]}_{flow[i]}"
        prev = "pv" if i == 1 else f"{flow[i - 2]}_{flow[i - 1]}"
        rows.append((i, pair, prev))
    schema = T.StructType([T.StructField("step", T.IntegerType()), T.StructField("pair", T.StringType()),
                           T.StructField("prev_pair", T.StringType())])
    return spark.createDataFrame(rows, schema)


def page_transitions(actions: DataFrame, tie_break: str = "event_id") -> DataFrame:
    """WIN4: for each action, ``page_id + '_' + next page_id`` of the same
    session in time order (``tie_break`` orders same-second actions); the last
    action of a session has no pair and is dropped.

    The successor is taken minute by minute, then from the last action of a
    minute to the next one, so a hot session is split over many tasks (see
    ``ordered``)."""
    base = actions.select("session_id", "action_time", tie_break, "page_id")
    nxt = next_in_group(base, "session_id", ["action_time", tie_break], "page_id", "_next",
                        slice_by=F.substring("action_time", 1, len("yyyy-MM-dd HH:mm")))
    return (nxt.where(F.col("_next").isNotNull())
            .select("session_id", tie_break,
                    F.concat(F.col("page_id").cast("string"), F.lit("_"), F.col("_next").cast("string")).alias("pair")))


def page_pairs(actions: DataFrame, flow: Sequence[int], tie_break: str = "event_id") -> DataFrame:
    """FLT7 + AGG11: transitions that are steps of the target flow, counted."""
    spark = actions.sparkSession
    steps = F.broadcast(flow_steps(spark, flow).select("pair"))
    return (page_transitions(actions, tie_break).join(steps, "pair", "left_semi")
            .groupBy("pair").agg(F.count(F.lit(1)).alias("cnt")))


def start_page_pv(actions: DataFrame, flow: Sequence[int]) -> DataFrame:
    """AGG12: views of the first page of the flow (one row, 0 when none)."""
    start = int(flow[0])
    return (actions.where(F.col("page_id") == start)
            .agg(F.count(F.lit(1)).cast("bigint").alias("pv"))
            .select(F.lit(start).cast("bigint").alias("page_id"), "pv"))


def funnel_conversion(actions: DataFrame, flow: Sequence[int], rounded: bool = True,
                      tie_break: str = "event_id") -> DataFrame:
    """WIN5 / JOB2 / JOB3: per flow step, the pair count and its ratio to the
    previous step (to the start page's views for step 1).  A step without
    transitions counts 0; a zero denominator gives a null rate.

    The previous step's count is looked up by key in the (flow-sized) count
    table instead of a global ``lag`` window, so no single-partition window is
    needed."""
    spark = actions.sparkSession
    steps = flow_steps(spark, flow)
    pairs = page_pairs(actions, flow, tie_break).select("pair", "cnt")
    pv = start_page_pv(actions, flow).select(F.lit("pv").alias("pair"), F.col("pv").alias("cnt"))
    counts = F.broadcast(pairs.unionByName(pv))
    cur = counts.select(F.col("pair"), F.col("cnt").alias("cur_cnt"))
    prev = counts.select(F.col("pair").alias("prev_pair"), F.col("cnt").alias("prev_cnt"))
    j = (steps.join(cur, "pair", "left").join(prev, "prev_pair", "left")
         .select("step", "pair", F.coalesce("cur_cnt", F.lit(0)).cast("bigint").alias("cnt"),
                 F.coalesce("prev_cnt", F.lit(0)).cast("bigint").alias("den")))
    rate = half_up_ratio("cnt", "den") if rounded else raw_ratio("cnt", "den")
    return j.select("step", "pair", "cnt", rate.alias("rate"))


def funnel_string(actions: DataFrame, flow: Sequence[int], tie_break: str = "event_id") -> DataFrame:
    """JOB4: the rounded funnel as one string ``1_2=0.50|2_3=...`` in step order."""
    f = funnel_conversion(actions, flow, True, tie_break)
    # format_string('%.2f', NULL) gives 'nu' (Java formats null with the
    # precision), so null rates take their own branch
    rate = F.when(F.col("rate").isNotNull(), F.format_string("%.2f", F.col("rate"))).otherwise(F.lit("null"))
    item = F.concat(F.col("pair"), F.lit("="), rate)
    return (f.select("step", item.alias("item"))
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("step", "item"))),
                                          lambda s: s["item"]), "|").alias("convert_rate")))
