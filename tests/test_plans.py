"""Plan checks: built-in expressions only (no Python UDF nodes), the
physical operators the design relies on, pruning/pushdown, and no driver
collection in library code."""

import pathlib
import re

import pytest

from clickscope.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
STREAMING = {"ads_stream_parse", "ads_city_running", "ads_minute_trend", "ads_blacklist_stream",
             "ads_province_top3_stream", "ads_sliding_hour_stream"}
PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas",
            "AggregateInPandas", "MapInArrow")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMING))
def test_no_python_in_plan(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not any(n in text for n in PY_NODES), name


@pytest.mark.parametrize("name", ["top_sessions_per_category", "area_top3", "ads_province_top3", "session_sample"])
def test_topk_uses_window_group_limit(spark, name):
    df = QUERIES[name](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in final, name


def test_top_categories_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_categories"](spark, SF))


def test_city_dimension_broadcast(spark):
    assert "BroadcastHashJoin" in plan(QUERIES["area_base"](spark, SF))


def test_date_range_prunes_partitions(spark):
    text = plan(QUERIES["actions_in_range"](spark, SF))
    assert re.search(r"PartitionFilters: \[[^\]]*date", text), text


def test_projection_pruned(spark):
    text = plan(QUERIES["area_clicks"](spark, SF))
    m = re.search(r"ReadSchema: struct<([^>]*)>", text)
    assert m and set(re.findall(r"(\w+):", m.group(1))) == {"click_product_id", "city_id"}


def test_no_driver_collection_in_library():
    root = pathlib.Path(__file__).resolve().parents[1] / "clickscope"
    offenders = []
    for f in root.rglob("*.py"):
        if f.parent.name == "llm":  # its collects are bounded, each says by what
            continue
        text = f.read_text()
        for pat in (".collect()", ".toPandas()", ".toLocalIterator(", "localCheckpoint"):
            if pat in text:
                offenders.append((f.name, pat))
    assert offenders == []
