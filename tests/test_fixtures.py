"""The materialized fixture tables equal their lazy derivations from the raw
driver tables (same rows, same column types)."""

import pytest

from clickscope.sources.fixtures import Fixture
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["visit_log", "users", "products", "ad_log"])
def test_materialized_equals_derived(spark, name):
    stored = getattr(Fixture(spark, SF), name)()
    raw = getattr(Fixture(spark, SF, materialize=False), name)()
    assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in raw.schema]
    assert rows(stored) == rows(raw)


def test_visit_log_is_date_partitioned(spark):
    import os
    root = Fixture(spark, SF).root().replace("file:", "")
    dates = sorted(d for d in os.listdir(os.path.join(root, "visit_log")) if d.startswith("date="))
    assert dates[0] == "date=2024-01-01" and len(dates) == 30


def test_replaced_source_is_derived_again(spark, tmp_path):
    """The same folder with another events table, in one session."""
    for name in ("customer", "part"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.write.parquet(f"{tmp_path}/events.parquet")
    assert Fixture(spark, str(tmp_path)).visit_log().count() == events.count()
    few = events.limit(100).cache()
    few.count()
    few.write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")
    assert Fixture(spark, str(tmp_path)).visit_log().count() == 100
    assert Fixture(spark, str(tmp_path)).ad_log().count() == 100
