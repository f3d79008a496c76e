"""One session / user / category / area holding a third of all rows: results
stay exact, and the plans keep the hot key's work split (partial aggregation
before the shuffle, partial top-k limits)."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from clickscope.operators import area as A
from clickscope.operators import categories as C
from clickscope.operators import funnel as FN
from clickscope.operators import sessions as S
from clickscope.sources.fixtures import cities
from tests.helpers import action, actions_df


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(11)
    data = []
    for i in range(3000):
        hot = i % 3 == 0
        sid = "HOT" if hot else f"s{rnd.randrange(300)}"
        sec = rnd.randrange(0, 3000)
        data.append(action(sid, f"2024-01-01 10:{sec // 60:02d}:{sec % 60:02d}", event_id=i,
                           user_id=1 if hot else rnd.randrange(2, 50), page_id=rnd.randrange(4),
                           click=(7 if hot else rnd.randrange(20)) if rnd.random() < 0.5 else -1,
                           city_id=0 if hot else rnd.randrange(10)))
    return data, actions_df(spark, data).repartition(6)


def test_summary_and_category_counts_exact(spark, skewed):
    data, df = skewed
    steps = Counter(r[2] for r in data)
    got = {r.session_id: r.step_length for r in S.session_summary(df).collect()}
    assert got == dict(steps)
    clicks = Counter(r[6] for r in data if r[6] != -1)
    assert {r.category_id: r.click_count for r in C.category_counts(df).collect()} == dict(clicks)
    text = S.session_summary(df)._jdf.queryExecution().executedPlan().toString()
    assert text.index("partial_") > text.index("Exchange")  # partial aggregate below the shuffle


def test_hot_session_transitions(spark, skewed):
    data, df = skewed
    by = defaultdict(list)
    for r in data:
        by[r[2]].append((r[4], r[13], r[3]))
    want = Counter()
    for items in by.values():
        items.sort()
        for a, b in zip(items, items[1:]):
            want[f"{a[2]}_{b[2]}"] += 1
    assert Counter(r.pair for r in FN.page_transitions(df).collect()) == want


def test_hot_area_top3(spark, skewed):
    data, df = skewed
    clicks = df.where("click_product_id != -1").select("city_id", "click_product_id")
    base = A.area_base(clicks, cities(spark))
    counts = A.area_product_clicks(base)
    top = A.area_top3(counts.withColumn("product_name", F.lit("p")).withColumn("product_status", F.lit("Self")), 3)
    per_area = Counter(r.area for r in top.collect())
    assert per_area["华北"] == 3 and all(v <= 3 for v in per_area.values())
