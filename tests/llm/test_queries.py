"""The registered corpus queries against their DuckDB SQL at sf0.001."""

import duckdb
import pytest

import __spark_entry__
from clickscope.llm.queries import ORACLE, QUERIES

from .helpers import corpus

SF = "/root/testdata/sf0.001"


def test_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries()) and set(ORACLE) <= set(__spark_entry__.oracle_sql())


def same(spark, name, folder, files):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{folder}/{files}')")
    con.execute(f"create view conversations as select * from read_parquet('{SF}/conversations.parquet')")
    df = QUERIES[name](spark, folder)
    want = con.execute(ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    rows = sorted(tuple(str(r[c]) for c in sorted(names)) for r in df.collect())
    at = [names.index(c) for c in sorted(names)]
    assert rows == sorted(tuple(str(r[k]) for k in at) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, name):
    same(spark, name, SF, "documents.parquet")


@pytest.mark.parametrize("name", sorted(set(ORACLE) - {"op11_prefix_trie"}))  # it reads no documents
def test_matches_oracle_on_awkward_rows(spark, name, tmp_path):
    """Nulls, empty texts, repeated rows and ids, ties."""
    lines = [(k, "the same line stands here\nand Anna saw 12 of them\n" + "tail " * (k % 3), "en") for k in (80, 81, 82, 82, 82, 83)]
    rows = corpus(spark, [*lines, (None, lines[0][1], None), (None, None, None), (None, "", "en")])
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    same(spark, name, str(tmp_path), "documents.parquet/*.parquet")
