"""The stages on a small corpus: order, columns, and what each keeps."""

import corpus_pipeline
from clickscope.llm import decontamination, simhash
from clickscope.llm.common import written

from .helpers import corpus, plain
from .test_operators import brute_groups


def test_stages(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "sentencepiece"]
    item = " ".join(f"bench{k}" for k in range(20))
    folder = str(tmp_path / "sf")
    source = corpus(spark, [(70, "the on ing words before " + item + " and the tail", "en")])
    source.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before, out = docs, written(stage(spark, docs, folder), f"test-{name}")
        rows, left = plain(before), plain(out)
        if name == "sentencepiece":
            assert len(left) == len(rows) and set(before.columns) < set(out.columns)
        else:
            assert out.columns == before.columns
        if name == "language_id":
            assert {i for i, _ in rows} - {i for i, _ in left} == {50, 51, 52, 59}
        if name == "line_dedup":
            assert sorted(str(i) for i, _ in left) == sorted(str(i) for i, _ in rows)
        if name == "near_dedup":
            gone = {i for i, _, c in brute_groups(rows) if i is not None and c < i}
            assert {i for i, _ in left} == {i for i, _ in rows if i is not None} - gone
        if name == "decontamination":
            assert {i for i, _ in rows} - {i for i, _ in left} == {70}
        docs = out
    assert corpus_pipeline.run(spark, folder).count() == docs.count()


def test_null_and_repeated_ids_are_decided_by_row(spark):
    item = " ".join(f"bench{k}" for k in range(20))
    own = [" ".join(f"{n}word{k}" for k in range(40)) for n in "abcdefg"]
    rows = [(1, own[0]), (None, own[0]), (None, own[1]), (None, own[2]), (None, own[3]), (None, own[3]),
            (2, own[4]), (7, own[4]), (7, own[5]), (8, own[6]), (8, own[6])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = sorted(plain(simhash.keep_one(docs)), key=str)
    assert left == sorted([(1, own[0]), (None, own[1]), (None, own[2]), (None, own[3]), (2, own[4]), (7, own[5]), (8, own[6])], key=str)

    rows = [(None, own[0]), (None, f"before {item} after"), (None, own[1]), (5, own[2]), (5, f"some {item}"), (6, own[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = sorted(plain(decontamination.clean(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))), key=str)
    assert left == sorted([rows[0], rows[2], rows[3], rows[5]], key=str)
