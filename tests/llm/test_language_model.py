"""op8 against plain dictionaries: seatings are consistent, and scores follow from them by the
Pitman-Yor rule written out."""

import math
import os
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from clickscope.llm import language_model as lm
from clickscope.llm.common import crc32_of_id

from .helpers import sentence

D, S = lm.DISCOUNT, lm.STRENGTH


def texts():
    rng = random.Random(9)
    words = [a + b for a in ("run", "sit", "go", "the", "an") for b in ("s", "ing", "er", "", "ed", "x")]
    return [(k, sentence(rng, 40 + k, words)) for k in range(25)] + [(30, "new unseen words only"), (31, ""), (32, None), (None, "the runs")]


def tokens(text):
    return (text or "").encode().lower().split() + [lm.END]


class Plain:
    """One sample: customers and tables of every (level, context, word) in dictionaries."""

    def __init__(self, r: lm.Restaurants, word_of: dict):
        names = [word_of[int(h)] for h in r.words]
        self.c, self.t = Counter(), Counter()
        for w, ctx, c, t in zip(r.word2, r.context, r.c2, r.t2):
            self.c[2, int(ctx), names[w]], self.t[2, int(ctx), names[w]] = c, t
        for w, b, c, t in zip(r.word1, r.byte, r.c1, r.t1):
            self.c[1, int(b), names[w]], self.t[1, int(b), names[w]] = c, t
        for w, c, t in zip(names, r.c0, r.t0):
            self.c[0, 0, w], self.t[0, 0, w] = c, t
        self.all_c, self.all_t = Counter(), Counter()
        for (level, ctx, _), c in self.c.items():
            self.all_c[level, ctx] += c
        for (level, ctx, _), t in self.t.items():
            self.all_t[level, ctx] += t
        self.base = r.base

    def p(self, level, ctx, word):
        up = self.base if level == 0 else self.p(level - 1, ctx & 255 if level == 2 else 0, word)
        key, at = (level, ctx, word), (level, ctx)
        rest = S[level] + D[level] * self.all_t[at]
        return (max(self.c[key] - D[level] * self.t[key], 0) + rest * up) / (S[level] + self.all_c[at])


def test_scores_follow_from_the_seatings(spark):
    rows = texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = {r["doc_id"]: r["h"] % 4294967296 % 7 == 2 for r in docs.select("doc_id", crc32_of_id().alias("h")).collect()}
    counts = Counter()
    for i, text in rows:
        if not held[i]:
            before = lm.FIRST
            for w in tokens(text):
                counts[w, before] += 1
                before = lm._context(w)
    word_of = {xxhash.xxh64_intdigest(w): w for w, _ in counts}
    order = sorted((xxhash.xxh64_intdigest(w), ctx, n) for (w, ctx), n in counts.items())
    distinct = sorted(word_of)
    row = {"bucket": 0, "words": np.array(distinct, np.uint64).tobytes(),
           "many": lm.pack(np.array([sum(h == d for h, _, _ in order) for d in distinct], np.uint32)),
           "contexts": lm.pack(np.array([c for _, c, _ in order], np.uint16)), "counts": lm.pack(np.array([n for _, _, n in order], np.int64))}
    r = lm.Restaurants(row, len(distinct))
    samples = []

    def totals():
        return lm.Totals(r.sums().groupby(["level", "place"], as_index=False).sum().itertuples(index=False))

    T = totals()
    for k in range(lm.SWEEPS):
        r.sweep(T, k)
        T = totals()
        own = Plain(r, word_of)
        for key, c in own.c.items():  # everyone sits, no table is empty
            assert 1 <= own.t[key] <= c
        for (level, ctx, w), c in own.c.items():  # a table is a customer of the parent
            if level == 1:
                assert c == sum(t for (lv, x, v), t in own.t.items() if lv == 2 and x & 255 == ctx and v == w)
            if level == 0:
                assert c == sum(t for (lv, _, v), t in own.t.items() if lv == 1 and v == w)
        if k >= lm.BURN_IN:
            samples.append(own)
    some = samples[0]
    assert abs(sum(some.p(2, lm._context(b"the"), w) for w in word_of.values()) + some.p(2, lm._context(b"the"), b"?") - 1) < 1e-9
    # the registered operator deals words to buckets; one bucket has the seed of this model
    got = {row["doc_id"]: row["score"] for row in one_bucket(docs)}
    for i, text in rows:
        want, before = 0.0, lm.FIRST
        for w in tokens(text):
            want += math.log10(np.mean([s.p(2, before, w) for s in samples]))
            before = lm._context(w)
        assert abs(got[i] - want) < 1e-3 * max(1, abs(want)), (i, got[i], want)


def one_bucket(docs):
    kept = lm.BUCKETS
    lm.BUCKETS = 1
    try:
        return lm.scores(docs).collect()
    finally:
        lm.BUCKETS = kept


def test_a_whole_word_is_the_context(spark):
    """Words with the same last letters that lead to different words are told apart."""
    rng = random.Random(1)
    after = {"running": "fast", "sitting": "still", "winning": "big", "thinking": "deep"}
    rows = [(k, " ".join(f"{w} {after[w]}" for w in rng.choices(sorted(after), k=30))) for k in range(60)]
    docs = spark.createDataFrame(rows + [(100, "running fast " * 10), (101, "running still " * 10)], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in lm.scores(docs).collect()}
    assert got[100] > got[101] + 5


def test_words_with_one_head_have_restaurants_of_their_own(spark):
    """Words before that agree in their last byte and eight bits of hash lead to different words."""
    heads = {}
    for k in range(100_000):
        heads.setdefault(lm._context(b"w%d" % k), []).append(f"w{k}")
    one, other = max(heads.values(), key=len)[:2]
    docs = spark.range(80).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, f"{one} left " * 20).otherwise(f"{other} right " * 20).alias("text"))
    got = [r["score"] for r in lm.scores(docs).where("held_out").collect()]
    # the first word, and whether the text ends, are open; "left" and "right" are nearly sure, where a shared restaurant loses 20 * log10(2)
    assert len(got) > 5 and min(got) > -5


def test_chunks_are_sent_without_a_table(spark, monkeypatch):
    """Until counts are learned, what chunks send lies in no table of its own, and what they ask for are rising numbers of
    pairs; chunks change no score."""
    rng = random.Random(6)
    words = [f"{rng.choice('abcdefgh')}{k * 7919 % 99991}" for k in range(20_000)]
    weights = [1 / (k + 3) for k in range(len(words))]
    rows = [(k, " ".join(rng.choices(words, weights, k=200))) for k in range(3000)]
    size, held, write = sum(len(t) for _, t in rows), {}, lm.written

    def written(df, name, *a, **b):
        out = write(df, name, *a, **b)
        if "lm-learned" not in held:
            held[name] = sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(out.table_path.removeprefix("file:"))
                             for f in names if f.endswith(".parquet"))
        return out
    monkeypatch.setattr(lm, "written", written)
    got = []
    for n in (1, 6):
        held.clear()
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(n)
        got.append({r["doc_id"]: (r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in lm.scores(docs).collect()})
    assert sum(held.values()) < 1.2 * size, held
    assert len(got[0]) == len(rows) and got[0].keys() == got[1].keys()
    for k, v in got[0].items():
        assert v == pytest.approx(got[1][k], rel=1e-9)
