"""Clashing column names, whole bags and filters, marks of scripts, split overflow, long texts."""

import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from clickscope.llm import (decontamination, language_id, line_dedup, quality_classifier, quality_rules, sentencepiece_codec, sharding, simhash,
                            substring_dedup)
from clickscope.llm.common import crc32_of_id

from .helpers import corpus, sentence

MODEL = public_tokenizers.path("piece_bpe_32k.model")
CLASHES = ["__row", "__gone", "__key", "__id", "__lang", "__trip", "__p", "doc", "gone", "row", "key", "of", "p", "trip", "a.b", "od`d", "id", "leaf"]


def test_stages_keep_columns_of_any_name(spark):
    docs = corpus(spark).select("doc_id", "text", "lang", *[F.lit(f"own {c}").alias(c) for c in CLASHES])
    item = spark.createDataFrame([(1, "no such passage stands in any of the texts here at all")], "item_id long, text string")
    for out in (line_dedup.without_recurring(docs), language_id.accepted(docs), simhash.keep_one(docs), decontamination.clean(docs, item)):
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r[c] == f"own {c}" for r in rows for c in CLASHES)
    out = sentencepiece_codec.with_round_trip(docs.withColumn("n_tokens", F.lit("old")), MODEL)
    assert out.columns == [*docs.columns, "n_tokens", "token_ids"]
    assert all(r[c] == f"own {c}" for r in out.collect() for c in CLASHES)


def test_language_filters_equal_sets_of_all_grams(spark):
    """Without Bloom filters: every n-gram of every learning text, rare ones included."""
    docs = corpus(spark)
    rows = docs.select("doc_id", "text", "lang", crc32_of_id().alias("h")).collect()
    sets, totals = defaultdict(Counter), Counter()
    for r in rows:
        if r["lang"] is not None and r["h"] % 4 != 2:
            g = language_id.grams(r["text"]).tolist()
            sets[r["lang"]].update(g)
            totals[r["lang"]] += len(g)
    filters = language_id.learn(docs)
    assert filters.names == sorted(sets)
    for k, name in enumerate(filters.names):  # no n-gram is left out
        at = language_id.slots(np.array(sorted(sets[name]), np.uint32), len(filters.table))
        hit = np.bitwise_and.reduce([filters.table[a, k // 63] for a in at])
        assert (hit >> np.uint64(k % 63) & np.uint64(1)).all()
    for r in language_id.predictions(docs).collect():
        text = next(x["text"] for x in rows if x["doc_id"] == r["doc_id"]) if r["doc_id"] is not None else None
        if text is None:
            continue
        g = language_id.grams(text).tolist()
        held = {n: sum(x in sets[n] for x in g) for n in filters.names}
        if not sum(held.values()):
            assert r["score"] == 0
            continue
        share = {n: {x: sets[n][x] / totals[n] for x in g} for n in filters.names}
        common = {n: sum(share[n][x] >= max(1e-5, 0.2 * max(share[m][x] for m in share)) for x in g) for n in filters.names}
        decide = common if sum(common.values()) else held
        assert decide[r["lang_pred"]] >= max(decide.values()) - 0.01 * len(g) - 1
        assert abs(r["score"] - decide[r["lang_pred"]] / sum(decide.values())) < 0.02
        assert abs(r["cover"] - held[r["lang_pred"]] / len(g)) < 0.02


def test_marks_stay_with_their_letters():
    hindi, thai = "हिन्दी में लिखा हुआ", "ภาษาไทยที่นี่ กับน้ำ"
    assert decontamination.words(hindi) == hindi.split() and decontamination.words(thai) == thai.split()
    for text in (hindi, thai):
        raw = np.array([language_id.grams(text)]).astype("<u4")
        assert len(raw[0]) == len(text.encode())
    assert not len(language_id.grams("ँ ั 12 ½"))  # marks and numbers alone


def test_whole_bags_and_fewer_documents(spark, monkeypatch):
    rng = random.Random(2)
    words = ["good", "fine", "clear", "plain"]
    texts = []
    for k in range(60):  # the passage that makes the label stands behind 70 others
        tail = sentence(rng, 64, ["junk", "spam", "click"]) if k % 2 else sentence(rng, 64, words)
        texts.append((k, sentence(rng, 64 * 70, words) + " " + tail, k))
    docs = spark.createDataFrame([t[:2] for t in texts], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1 - k % 2, 0) for k in range(60)], "doc_id long, quality long, toxic long")
    got = {r["doc_id"]: r for r in quality_classifier.scores(docs, labels).collect()}
    held = [r for r in got.values() if r["held_out"]]
    assert held and all((r["score"] > 0.5) == (r["doc_id"] % 2 == 0) for r in held)
    monkeypatch.setattr(quality_classifier, "TRAIN_PASSAGES", 10 * 71)
    seen = []
    fit = quality_classifier.Model.fit
    monkeypatch.setattr(quality_classifier.Model, "fit", lambda self, bags, y: seen.append([len(b) for b in bags]) or fit(self, bags, y))
    quality_classifier.train(docs, labels)
    assert seen == [[71] * 10]


def test_overflow_is_split_and_does_not_depend_on_partitions(spark):
    rng = random.Random(3)
    sizes = [rng.choice([3, 40, 40, 40, 90, 700]) for _ in range(900)]
    docs = spark.createDataFrame([(7, "x" * n) for n in sizes] + [(8, "y" * 50)], "doc_id long, text string")
    limit, found = 500, []
    for n in (1, 3, 8):
        out = sharding.shards(docs.repartition(n), limit).collect()
        found.append(sorted((r["doc_id"], r["bytes"], r["shard_id"], r["shard_bytes"], r["oversized"]) for r in out))
    assert found[0] == found[1] == found[2] and len(found[0]) == 901
    sums = Counter()
    for _, size, shard, _, _ in found[0]:
        sums[shard] += size
    for _, size, shard, total, over in found[0]:
        assert total == sums[shard] and over == (total > limit) and (total <= limit or total == size)
    # places in order of bytes, as one running count over all rows would deal them
    want, at = Counter(), 0
    for rank, size in enumerate(sorted(sizes)):
        want[f"+b{rank}" if 2 * size > limit else f"+s{at // (limit // 2)}"] += size
        at += size
    assert sorted(want.values()) == sorted(v for k, v in sums.items() if "+" in k)


def test_very_long_texts(spark, tmp_path):
    """A text of 400,000 words beside short ones, in every operator that reads whole texts."""
    rng = random.Random(6)
    long = " ".join(f"w{rng.randrange(50_000)}" for _ in range(400_000))
    docs = spark.createDataFrame([(1, long, "en"), (2, long + " end", "en"), (3, "some short text of a few words", "en")],
                                 "doc_id long, text string, lang string")
    comp = {r["doc_id"]: r["component_id"] for r in simhash.near_groups(docs).collect()}
    assert comp == {1: 1, 2: 1, 3: 3}
    assert {r["doc_id"]: r["n_words"] for r in quality_rules.quality(docs).collect()} == {1: 400_000, 2: 400_001, 3: 7}
    cut = {r["doc_id"]: (r["n_removed"], r["longest"]) for r in substring_dedup.dedup(docs).collect()}
    assert cut[1][0] == 0 and cut[2][0] == 400_000 and cut[3] == (0, 0)
    assert cut[2][1] == 13 * 2 ** int(np.log2(400_000 / 13))
    assert {r["doc_id"]: r["n_dropped"] for r in line_dedup.summary(docs).collect()} == {1: 0, 2: 0, 3: 0}
    assert {r["lang_pred"] for r in language_id.predictions(docs).collect()} == {"en"}
    ids = {r["doc_id"]: r["n_tokens"] for r in sentencepiece_codec.encode_documents(docs, MODEL).collect()}
    assert ids[2] == ids[1] + 1
    assert sharding.shards(docs, 1 << 20).count() == 3
