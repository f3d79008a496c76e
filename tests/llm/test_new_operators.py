"""Operators 11 to 13: awkward rows, brute force, several batches."""

import hashlib
import math
import zlib
from collections import defaultdict

import duckdb
import pytest

from clickscope.llm import divergence_audit, exact_dedup, prefix_trie
from clickscope.llm.queries import QUERIES
from clickscope.session import run_dir

from .helpers import corpus

TALK = "conv_id long, turn long, role string, text string, depth int, x long, slice int, n string"


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names or sorted(df.columns)) for r in df.collect()), key=str)


def sql_rows(con, sql):
    q = con.execute(sql)
    names = [d[0] for d in q.description]
    at = [names.index(n) for n in sorted(names)]
    return sorted((tuple(r[k] for k in at) for r in q.fetchall()), key=str)


def talk(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "x") for r in rows], TALK)


def brute_trie(rows, head=lambda c: zlib.crc32(str(c).encode()) % 6):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    whole = {c: own.get(c - int(math.fmod(c, 100)), [])[:head(c)] + s[head(c):] for c, s in own.items()}
    members = defaultdict(list)
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    out = []
    for node, convs in members.items():
        under = [x for x in members if x[:len(node)] == node]
        kids = [x for x in under if len(x) == len(node) + 1]
        last = sorted(c for c in convs if len(whole[c]) == len(node))
        out.append((min(convs), len(node), hashlib.sha256(",".join(map(str, last)).encode()).hexdigest(), len(kids), len(convs),
                    sum(1 for x in under if not any(len(y) == len(x) + 1 and y[:len(x)] == x for y in members)),
                    min(members[node[:-1]]) if node else None,
                    sum((len(members[x]) - 1) * len(x[-1][1]) for x in under if x)))
    return sorted(out, key=str)


AWKWARD = [
    (0, 0, "user", "hello"), (0, 1, "bot", "hi there"), (0, 2, "user", "bye"), (0, None, None, None),
    (1, 0, "user", "own first"), (1, 5, "bot", "x"), (2, 0, "user", ""), (2, 0, "user", ""), (2, 0, "bot", "tie"),
    (3, 3, "user", "漢字 😀"), (7, None, None, None), (7, None, "a", None), (-3, 0, "user", "negative"), (-3, 1, "user", "more"),
    (105, 0, "user", "no base"), (None, 0, "user", "no id"), (None, None, None, None), (250, 1, "u", "a"), (251, 1, "u", "a"),
]


@pytest.mark.parametrize("rows", [AWKWARD, AWKWARD + [(c, t, "u", f"turn {t % 7}") for c in (200, 201, 300) for t in range(700)]])
def test_trie_equals_brute_force(spark, rows):
    got = prefix_trie.nodes(talk(spark, rows))
    names = sorted(got.columns)
    assert names == ["conv_id", "depth", "ends_sha256", "n_children", "n_convs", "n_leaves", "parent_conv_id", "saved_tokens"]
    assert rows_of(got) == brute_trie(rows)


def test_trie_of_nothing_and_of_many_equal_conversations(spark):
    assert prefix_trie.nodes(talk(spark, [])).count() == 0
    assert prefix_trie.nodes(talk(spark, [(None, 1, "u", "x")])).count() == 0
    rows = [(c, t, "u", f"same {t}") for c in range(0, 90_000, 7) for t in range(2)]
    got = {r["depth"]: r for r in prefix_trie.nodes(talk(spark, rows), base="-1L", head="0").collect()}
    ids = ",".join(str(c) for c in range(0, 90_000, 7))  # several blocks of ids
    assert sorted(got) == [0, 1, 2] and got[2]["ends_sha256"] == hashlib.sha256(ids.encode()).hexdigest()
    assert got[0]["n_convs"] == len(range(0, 90_000, 7)) and got[0]["n_leaves"] == 1


def test_trie_matches_its_sql_on_awkward_rows(spark, tmp_path):
    talk(spark, AWKWARD).select("conv_id", "turn", "role", "text").write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    got = QUERIES["op11_prefix_trie"](spark, str(tmp_path))
    assert rows_of(got) == sql_rows(con, prefix_trie.ORACLE)


def audit_sql(docs):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "lang", "source").toPandas())
    return sql_rows(con, divergence_audit.ORACLE)


def test_audit_with_small_buckets_equals_sql(spark):
    docs = corpus(spark, [(90 + k, "alpha beta Alpha ünï gamma " * (k + 1), "en", ) for k in range(6)])
    docs = docs.selectExpr("doc_id", "text", "lang", "case when doc_id % 5 = 0 then null else concat('s', doc_id % 5) end as source",
                           "1 as sid", "2L as p0", "'c' as term", "3 as peers")
    audit = divergence_audit.Audit(docs)
    want = audit_sql(docs)
    assert rows_of(divergence_audit.report(docs)) == want
    small = divergence_audit.pairs(audit, bucket_entries=7)
    assert rows_of(small, "lang", "source", "item", "value") == sorted(
        [(r[1], r[4], r[0], r[5]) for r in want if r[2] == "pair"], key=str)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None)], [(1, "a b", "en", "x"), (2, None, "en", "y"), (None, "", "en", None)],
                                  [(k, "one two Two", "en", f"s{k % 2}") for k in range(7)] + [(9, "123 !!", "fr", "only")]])
def test_audit_of_few_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert rows_of(divergence_audit.report(docs)) == audit_sql(docs)


def test_audit_reads_a_very_long_text(spark):
    long = " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}" for k in range(300_000))
    docs = spark.createDataFrame([(k, long if k == 0 else "wab wac wab", "en", f"s{k % 3}") for k in range(6)],
                                 "doc_id long, text string, lang string, source string")
    assert rows_of(divergence_audit.report(docs)) == audit_sql(docs)


def exact_sql(docs):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"}))
    return sql_rows(con, exact_dedup.ORACLE)


def awkward(spark):
    return corpus(spark, [(90, "THE Same", "en"), (91, "the same", "en"), (None, "the SAME", "en"), (None, None, None), (None, "", "en"),
                          (None, "only nulls", "en"), (None, "ONLY nulls", "en"), (92, "É the", "fr"), (93, "é the", "fr"),
                          (94, "long " * 300_000, "en"), (95, "LONG " * 300_000, "en")])


def test_exact_dedup_on_awkward_rows(spark, tmp_path):
    docs = awkward(spark).selectExpr("*", "'x' as file", "1 as row", "'d' as digest", "5 as top")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_exact_dedup"](spark, str(tmp_path))
    assert rows_of(got) == exact_sql(spark.read.parquet(f"{tmp_path}/documents.parquet"))


def test_exact_dedup_over_batches_and_restarts(spark, tmp_path):
    """Files that come later, one to a micro-batch, meet the state of the earlier ones."""
    path, root = f"{tmp_path}/docs", run_dir(spark, "exact-test")
    docs = awkward(spark)
    for k in range(3):
        docs.where(f"pmod(xxhash64(doc_id, text), 3) = {k}").coalesce(2).write.mode("append").parquet(path)
        exact_dedup.ingest(spark, path, root, batch_files=1)
        assert exact_dedup.state(spark, root).count() == spark.read.parquet(path).selectExpr(
            "count(distinct translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as n").first()["n"]
    exact_dedup.ingest(spark, path, root)  # nothing new
    got = exact_dedup.decided(spark, path, root).selectExpr("doc_id", "group_size", "keep_id", "kept", "lower(hex(digest)) as text_sha256")
    assert rows_of(got) == exact_sql(docs)


def test_exact_dedup_compares_bytes_where_digests_collide(spark, tmp_path):
    """A digest of two bits: only the bytes tell the texts apart."""
    path, root = f"{tmp_path}/docs", run_dir(spark, "exact-test")
    docs = awkward(spark)
    docs.repartition(2).write.parquet(path)
    exact_dedup.ingest(spark, path, root, digest=lambda text: bytes([len(text) % 4]))
    assert exact_dedup.state(spark, root).count() == 4
    got = exact_dedup.decided(spark, path, root)
    assert rows_of(got, "doc_id", "group_size", "keep_id", "kept") == sorted([r[:4] for r in exact_sql(docs)], key=str)


def test_exact_dedup_of_an_empty_table(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op13_exact_dedup"](spark, str(tmp_path)).count() == 0
