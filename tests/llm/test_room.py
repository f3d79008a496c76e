"""Disk and memory that operators take beside their results."""

import glob

from public_tokenizers import path as tokenizer

from clickscope.llm import exact_dedup, substring_dedup
from clickscope.llm.sentencepiece_codec import Codec
from clickscope.session import work_dir


def test_state_stores_take_no_room_ahead(spark, scratch, monkeypatch):
    key = "spark.sql.streaming.stateStore.rocksdb.allowFAllocate"
    before, seen, read = spark.conf.get(key, None), [], exact_dedup.state

    def state(*a):
        seen.append(spark.conf.get(key, None))
        return read(*a)
    monkeypatch.setattr(exact_dedup, "state", state)
    spark.createDataFrame([(1, "A b"), (2, "a B"), (3, None)], "doc_id long, text string").write.parquet(f"{scratch}/in")
    got = exact_dedup.dedup(spark, f"{scratch}/in", f"{scratch}/run").collect()
    assert sorted((r["doc_id"], r["keep_id"], r["kept"]) for r in got) == [(1, 2, False), (2, 2, True), (3, 3, True)]
    assert seen == ["false"] and spark.conf.get(key, None) == before


def test_chunks_of_substring_dedup_go_when_judged(spark):
    def tables():
        return set(glob.glob(f"{work_dir(spark).removeprefix('file:')}/substring-chunks-*"))
    before, words = tables(), " ".join(f"w{k}" for k in range(40))
    docs = spark.createDataFrame([(1, words), (2, words + " end")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["longest"]) for r in substring_dedup.dedup(docs).collect())
    assert got == [(1, 40, 0, 26), (2, 41, 40, 26)]
    assert tables() == before


def test_a_sparing_codec_remembers_what_comes_again():
    model = tokenizer("piece_bpe_32k.model")
    plain, sparing = Codec(model), Codec(model, sparing=True)
    texts = [f"unlike{k} the same words 漢字 😀" for k in range(50)]
    assert [sparing.encode(t) for t in texts] == [plain.encode(t) for t in texts]
    assert len(sparing.known) < len(plain.known)
    assert all(isinstance(x, bytes) for x in plain.known.values())
    assert [list(sparing.ids(t)) for t in texts] == [plain.sp.encode(t, add_eos=True) for t in texts]
