import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from clickscope.operators import funnel as FN
from clickscope.operators.ordered import next_in_group
from clickscope.sources.fixtures import Fixture
from tests.conftest import rows


def _brute(data):
    """Python reference: successor per group in (t, id) order."""
    out = {}
    by = {}
    for g, t, i, v in data:
        by.setdefault(g, []).append((t, i, v))
    for g, items in by.items():
        items.sort()
        for k, (t, i, v) in enumerate(items):
            out[i] = items[k + 1][2] if k + 1 < len(items) else None
    return out


def test_slices_agree_with_brute_force(spark):
    rnd = random.Random(7)
    # one hot group with most rows, ties on t, plus many small groups
    data = [("hot", rnd.randrange(50), i, rnd.randrange(10)) for i in range(600)]
    data += [(f"g{rnd.randrange(40)}", rnd.randrange(50), 600 + i, rnd.randrange(10)) for i in range(300)]
    df = spark.createDataFrame(data, "g string, t int, id bigint, v int").repartition(5)
    want = _brute(data)
    for width in (1, 7, 1000):  # one time a slice, several, all of them
        got = {r.id: r.nxt for r in next_in_group(df, "g", ["t", "id"], "v", "nxt", slice_by=F.floor(F.col("t") / width)).collect()}
        assert got == want, width


def test_transitions_match_a_plain_window(spark):
    acts = Fixture(spark, "/root/testdata/sf0.001").visit_log()
    a = rows(FN.page_transitions(acts))
    nxt = F.lead("page_id").over(Window.partitionBy("session_id").orderBy("action_time", "event_id"))
    plain = acts.select("session_id", "event_id", "page_id", nxt.alias("n")).where("n is not null")
    assert a == rows(plain.select("session_id", "event_id", F.concat("page_id", F.lit("_"), "n").alias("pair")))
    assert len(a) == 1000 - acts.select("session_id").distinct().count()


def test_empty_input(spark):
    df = spark.createDataFrame([], "g string, t int, id bigint, v int")
    assert next_in_group(df, "g", ["t", "id"], "v", "nxt", slice_by=F.col("t")).count() == 0


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 5), st.integers(0, 9)),
                min_size=1, max_size=80),
       st.sampled_from([1, 2, 9]), st.integers(1, 6))
def test_successor_property(spark, items, width, parts):
    data = [(g, t, i, v) for i, (g, t, v) in enumerate(items)]
    df = spark.createDataFrame(data, "g string, t int, id bigint, v int").repartition(parts)
    got = {r.id: r.nxt for r in next_in_group(df, "g", ["t", "id"], "v", "nxt", slice_by=F.floor(F.col("t") / width)).collect()}
    assert got == _brute(data)
