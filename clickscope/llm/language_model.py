"""LM scoring with a hierarchical Pitman-Yor model.

The context of a token is the whole word before it: every word has a restaurant of its own, told
apart by a 64-bit key, so their number grows with the vocabulary.  Its parent restaurant is the
class of words with the same last byte, whose parent is the root; the root's base is uniform over the
learned words and one unknown word.  In a restaurant every customer of a word sits at a
table (Chinese-restaurant process with discount and strength) and every table
sends one customer to the parent restaurant.

Seating is sampled by blocked Gibbs sweeps: the customers of one (restaurant, word)
leave and sit down again, given the parent's predictive probability and the
restaurant's number of tables after the sweep before.  All customers of one
word lie in one bucket, as counts, so parents and children meet there.  A restaurant of a word before
has customers in many buckets: after each sweep every bucket sends its sums of the contexts that it
knows or is asked for to the context's part, and the totals come back (a shuffle, nothing on the driver).
Only the sums of the 257 restaurants above are gathered.  Seatings are written after each
sweep.  Predictive probabilities are averaged over the sweeps after the burn-in.

Texts are read once, in chunks of bounded size: a chunk sends each distinct
(word, context) once to the word's bucket and gets its probability and count back,
so a word that a third of all tokens are is sent at most once a chunk.  A bucket numbers
its distinct pairs, learned or only asked for, keeps of every chunk the rising numbers
of its pairs, and finds the probability of each pair once.  All learned counts come
from the whole corpus.

Cases: a null or empty text is its end token alone; an unknown word or context
falls back to the parents; null ids are learned from like the empty id's fold;
repeated rows are each learned from and scored; if nothing is learned the base
is one unknown word; an empty table gives an empty table; only doc_id and text are read.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count, repeat
from operator import itemgetter
from zlib import crc32

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc32_of_id, drop_tables, pack, prepared, unpack, written

#: Discount and strength of the root, of the classes of words and of the words before.
DISCOUNT = (0.5, 0.6, 0.7)
STRENGTH = (1.0, 1.0, 1.0)
SWEEPS, BURN_IN = 6, 2
CHUNK = 12_000_000
#: Text bytes for each bucket of words.
PER_BUCKET = 12_000_000
BUCKETS = 12
#: Contexts, counted for each bucket, of one part.
PER_PART = 500_000
END = b"\n"  # no word holds it
FIRST = 0  # context of a text's first token
SEED = 17


def _context(word: bytes) -> int:
    """Head of a word's key: eight bits of hash and its class, the last byte, in the low byte.  Words may share it."""
    return word[-1] | crc32(word) >> 24 << 8


def _keys(words: list[bytes]) -> np.ndarray:
    """Keys of words as contexts: the head (``_context``), then 48 bits of a second hash (never 0, which is FIRST)."""
    last, crc, rest = (np.fromiter(of, np.uint64, len(words)) for of in (
        map(itemgetter(-1), words), map(crc32, words), map(xxhash.xxh64_intdigest, words, repeat(SEED))))
    head = last | crc >> np.uint64(24) << np.uint64(8)
    return head << np.uint64(48) | np.maximum(rest & np.uint64((1 << 48) - 1), np.uint64(1))


def _distinct(codes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ones, ascending, of codes below 2**``bits``; the place of every code among them."""
    own = len(codes).bit_length()
    if not len(codes) or bits + own > 63:
        return np.unique(codes, return_inverse=True)
    s = np.sort(codes << own | np.arange(len(codes)))  # sorting values costs a fraction of sorting places
    value = s >> own
    new = np.ones(len(s), bool)
    new[1:] = value[1:] != value[:-1]
    at = np.empty(len(s), np.int64)
    at[s & (1 << own) - 1] = np.cumsum(new) - 1
    return value[new], at


def _union(parts: list[np.ndarray]) -> np.ndarray:
    """Distinct values of all parts, ascending."""
    s = np.sort(np.concatenate(parts))
    return s[np.flatnonzero(np.concatenate([s[:1] == s[:1], s[1:] != s[:-1]]))]


def _planes(a: np.ndarray) -> bytes:
    """Packed four-byte values: bytes of one weight together pack better."""
    return pack(a.view(np.uint8).reshape(-1, 4).T)


def _joined(b: bytes, dtype: str) -> np.ndarray:
    return np.ascontiguousarray(unpack(b, np.uint8).reshape(4, -1).T).view(dtype).reshape(-1)


def _rising(a: np.ndarray) -> bytes:
    """Packed ascending eight-byte values, by their differences."""
    return pack(np.diff(a.astype("<u8"), prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T)


def _risen(b: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(unpack(b, np.uint8).reshape(8, -1).T).view("<u8").reshape(-1), dtype=np.uint64)


def _steps(a: np.ndarray) -> bytes:
    """Packed four-byte values that mostly rise a little, by their differences."""
    return _planes(np.diff(a.astype("<u4"), prepend=np.uint32(0)))


def _stepped(b: bytes) -> np.ndarray:
    return np.cumsum(_joined(b, "<u4"), dtype=np.uint32).astype(np.int64)


def _emit(name: str, own: int, rows: list[tuple[int | None, bool, bytes]], buckets: int) -> pd.DataFrame:
    known: dict[bytes, int] = defaultdict(count().__next__)  # a new word gets the next number
    known[END]
    parts = []
    for _, _, t in rows:
        words = t.lower().split()
        parts.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
    size = np.array([len(p) + 1 for p in parts], np.int64)
    begin = np.cumsum(size) - size
    ids = np.zeros(int(size.sum()), np.int64)  # the end token is word 0
    for p, b in zip(parts, begin.tolist()):
        ids[b:b + len(p)] = p
    words = list(known)
    keys, context = np.unique(np.append(np.uint64(FIRST), _keys(words)), return_inverse=True)
    before = np.full(len(ids), context[0], np.int64)  # places in ``keys``
    before[1:] = context[1:][ids[:-1]]
    before[begin] = context[0]
    learn = np.repeat(np.array([not held for _, held, _ in rows], bool), size)
    word = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    # words in order of (bucket, hash), so that a chunk's pairs lie bucket by bucket
    bucket = (word % np.uint64(buckets)).astype(np.int64)
    by = np.argsort(word, kind="stable")
    by = by[np.argsort(bucket[by].astype(np.min_scalar_type(buckets)), kind="stable")]
    rank = np.empty(len(by), np.int64)
    rank[by] = np.arange(len(by))
    low = len(keys).bit_length()
    pair, of = _distinct(rank[ids] << low | before, len(by).bit_length() + low)
    n = np.bincount(of, weights=learn, minlength=len(pair)).astype(np.int64)
    first, before = pair >> low, pair & (1 << low) - 1
    cut_w = np.searchsorted(bucket[by], np.arange(buckets + 1))
    cut_p = np.searchsorted(first, cut_w)
    out = []
    for b in np.flatnonzero(np.diff(cut_w)).tolist():
        w, p = slice(cut_w[b], cut_w[b + 1]), slice(cut_p[b], cut_p[b + 1])
        many = np.bincount(first[p] - cut_w[b], minlength=cut_w[b + 1] - cut_w[b])
        some, at = _distinct(before[p], low)
        out.append((name, False, b, _rising(word[by][w]), pack(many.astype(np.uint32)),
                    _planes(at.astype("<u4")), pack(n[p].astype(np.uint32)), _rising(keys[some])))
    held = np.array([h for _, h, _ in rows], bool)
    named = np.array([-1 if i is None else i for i, _, _ in rows], np.int64)
    null = np.array([i is None for i, _, _ in rows], bool)
    out.append((name, True, own, pack(np.stack([named, size, held, null]).astype(np.int64)), _planes(of.astype("<u4")),
                pack(first.astype(np.uint32)), None, None))
    return pd.DataFrame(out, columns=["chunk", "tokens", "bucket", "a", "b", "c", "d", "e"])


def _sent(docs: DataFrame, buckets: int) -> DataFrame:
    """Packed rows: per (chunk, bucket) words, places of their contexts, learned counts and the contexts' keys;
    per chunk (``tokens``, with a negative bucket) its tokens."""
    def run(batches):
        task, k, held, size = TaskContext.get().partitionId(), 0, [], 0
        for pdf in batches:
            null = pdf["doc_id"].isna().tolist()
            for i, no, out, t in zip(pdf["doc_id"].tolist(), null, pdf["held_out"].tolist(), pdf["text"].tolist()):
                t = t or b""
                if held and size + len(t) > CHUNK:
                    yield _emit(f"{task}-{k}", -1 - (task << 8 | k) % (1 << 31), held, buckets)
                    held, size, k = [], 0, k + 1
                held.append((None if no else int(i), out, t))
                size += len(t)
        if held:
            yield _emit(f"{task}-{k}", -1 - (task << 8 | k) % (1 << 31), held, buckets)

    rows = docs.select("doc_id", (crc32_of_id() % 7 == 2).alias("held_out"), F.col("text").cast("binary").alias("text"))
    return rows.mapInPandas(run, "chunk string, tokens boolean, bucket int, a binary, b binary, c binary, d binary, e binary")


def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    """One bucket's distinct pairs of a word and a context, learned or only asked for, ascending, with learned counts;
    the keys of their contexts, ascending; and of each chunk the places of its pairs.  A chunk's tokens go through."""
    names = [x.split()[0] for x in LEARNED.split(", ")]
    if pdf["tokens"].iloc[0]:
        return pdf.rename(columns={"a": "words", "b": "contexts", "c": "many"}).reindex(columns=names).fillna(
            {"n_words": 0, "n_tokens": 0, "n_contexts": 0})
    hashes, keys = [_risen(a) for a in pdf["a"]], [_risen(e) for e in pdf["e"]]
    words, every = _union(hashes), _union(keys)
    low = len(every).bit_length()
    parts = [np.repeat(np.searchsorted(words, a), unpack(b, np.uint32)) << low | np.searchsorted(every, e)[_joined(c, "<u4")]
             for a, b, c, e in zip(hashes, pdf["b"], pdf["c"], keys)]
    pair, at = _distinct(np.concatenate(parts), len(words).bit_length() + low)
    counts = np.bincount(at, np.concatenate([unpack(d, np.uint32) for d in pdf["d"]]), len(pair)).astype(np.int64)
    word = pair >> low
    bucket, n = int(pdf["bucket"].iloc[0]), np.bincount(word, counts, len(words))
    rows = [(False, bucket, None, np.count_nonzero(n), int(counts.sum()), len(every), None, pack(np.bincount(word).astype(np.uint32)),
             _planes((pair & (1 << low) - 1).astype("<u4")), pack(counts), _rising(every))]
    for chunk, b, own in zip(pdf["chunk"], pdf["b"], np.split(at, np.cumsum([len(x) for x in parts])[:-1])):
        rows.append((False, bucket, chunk, 0, 0, 0, None, b, _steps(own), None, None))
    return pd.DataFrame(rows, columns=names)


#: A bucket (no chunk): its words' numbers of contexts, places of these, counts; what a chunk asks of it: its words' numbers of
#: contexts, places of its pairs; a chunk's tokens (``tokens``).
LEARNED = ("tokens boolean, bucket int, chunk string, n_words long, n_tokens long, n_contexts long, words binary, many binary, "
           "contexts binary, counts binary, keys binary")


class Totals:
    """Customers and tables of every restaurant, by level: 0 root, 1 class of words, 2 word before
    (of the ``contexts`` that a bucket knows, by their places there)."""

    def __init__(self, rows, contexts: int = 65536):
        self.c = [np.zeros(n, np.float64) for n in (1, 256, contexts)]
        self.t = [np.zeros(n, np.float64) for n in (1, 256, contexts)]
        for level, at, c, t in rows:
            self.c[level][at], self.t[level][at] = c, t


def seat(rng, customers: np.ndarray, weight: np.ndarray, discount: float) -> np.ndarray:
    """Tables after ``customers`` sat down one by one; ``weight``: (strength + discount
    * tables of the restaurant) * probability of the word in the parent.  The
    first 64 come singly; of more, a sixteenth of those seated come at once."""
    out = (customers > 0).astype(np.float64)
    order = np.flatnonzero(customers > 1)  # who comes alone has a table
    order = order[np.argsort(-customers[order], kind="stable")]
    c, a = customers[order], weight[order]
    t = np.ones(len(c))
    seated = 1
    while True:
        live = int(np.searchsorted(-c, -seated, side="left"))  # those with more customers than are seated
        if not live:
            break
        step = max(1, seated // 16) if seated >= 64 else 1
        p = a[:live] / (a[:live] + np.maximum(seated - discount * t[:live], 1e-9))
        come = np.minimum(step, c[:live] - seated)
        t[:live] += rng.random(live) < p if step == 1 else rng.binomial(come.astype(np.int64), p)
        seated += step
    out[order] = t
    return out


class Restaurants:
    """All restaurants of the words of one bucket.  Contexts are places in ``keys``; without keys they are
    heads (``_context``), each of one word."""

    def __init__(self, row, vocabulary: int):
        many, counts = unpack(row["many"], np.uint32), unpack(row["counts"], np.int64)
        self.keys = _risen(row["keys"]) if "keys" in row else None
        if self.keys is None:
            context, self.heads = unpack(row["contexts"], np.uint16).astype(np.int64), np.arange(65536)
            self.words = np.frombuffer(row["words"], np.uint64)
        else:
            context, self.heads = _joined(row["contexts"], "<u4").astype(np.int64), (self.keys >> np.uint64(48)).astype(np.int64)
        self.bucket, self.base = int(row["bucket"]), 1 / (vocabulary + 1)
        # of all pairs, asked for or learned: words, contexts, which are learned; of all words: counts, places of the learned ones
        self.of, self.at, self.held = np.repeat(np.arange(len(many)), many), context, np.flatnonzero(counts)
        self.count = np.bincount(self.of, counts, len(many))
        self.place = np.where(self.count > 0, np.cumsum(self.count > 0) - 1, -1)
        self.n = int(np.count_nonzero(self.count))
        self.word2, self.context, self.c2 = self.place[self.of[self.held]], context[self.held], counts[self.held].astype(np.float64)
        self.key1, self.up1 = _distinct(self.word2 << 8 | self.heads[self.context] & 255, self.n.bit_length() + 8)
        self.word1, self.byte = self.key1 >> 8, self.key1 & 255
        self.seated(np.ones(len(self.c2)), np.ones(len(self.key1)), np.ones(self.n))

    def dealt(self, parts: int) -> list[np.ndarray]:
        """Places of the contexts of each part; found once."""
        if not hasattr(self, "parts"):
            self.parts = _dealt(self.keys, parts)
        return self.parts

    def seated(self, t2, t1, t0) -> Restaurants:
        """Take over tables."""
        self.t2, self.t1, self.t0 = t2, t1, t0
        self._up()
        self._root()
        return self

    def _up(self):
        self.c1 = np.bincount(self.up1, self.t2, len(self.key1))

    def _root(self):
        self.c0 = np.bincount(self.word1, self.t1, self.n)

    def p0(self, T, c, t):
        return _predict(c, t, T.c[0][0], T.t[0][0], 0, self.base)

    def p1(self, T):
        return _predict(self.c1, self.t1, T.c[1][self.byte], T.t[1][self.byte], 1, self.p0(T, self.c0, self.t0)[self.word1])

    def sweep(self, T: Totals, k: int) -> None:
        rng = np.random.default_rng([SEED, self.bucket, k])
        d, s = DISCOUNT, STRENGTH
        self.t2 = seat(rng, self.c2, (s[2] + d[2] * T.t[2][self.context]) * self.p1(T)[self.up1], d[2])
        self._up()
        self.t1 = seat(rng, self.c1, (s[1] + d[1] * T.t[1][self.byte]) * self.p0(T, self.c0, self.t0)[self.word1], d[1])
        self._root()
        self.t0 = seat(rng, self.c0, np.full(self.n, (s[0] + d[0] * T.t[0][0]) * self.base), d[0])

    def sums(self) -> pd.DataFrame:
        out = []
        for level, at, c, t in ((2, self.context, self.c2, self.t2), (1, self.byte, self.c1, self.t1),
                                (0, np.zeros(self.n, np.int64), self.c0, self.t0)):
            size = (1, 256, len(self.heads))[level]
            cs, ts = np.bincount(at, c, size), np.bincount(at, t, size)
            some = np.flatnonzero(cs)
            out.append(pd.DataFrame({"level": level, "place": some, "c": cs[some], "t": ts[some]}))
        return pd.concat(out)

    def places(self, word: np.ndarray, context: np.ndarray) -> tuple:
        """Of words by their place here (-1: unknown) in their contexts: places in each level (-1: none), the same in every sample."""
        def found(keys, key):
            if not len(keys):
                return np.full(len(key), -1)
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            return np.where((keys[at] == key) & (word >= 0), at, -1)

        return word, found(self.key1, word << 8 | self.heads[context] & 255), found(self.word2 << 32 | self.context, word << 32 | context)

    def probability(self, T: Totals, word: np.ndarray, context: np.ndarray, places: tuple | None = None) -> np.ndarray:
        """Of words by their place here (-1: unknown) in their contexts."""
        at0, at1, at2 = places or self.places(word, context)

        def of(at, *values):
            return [np.append(v, 0)[at] for v in values]  # nothing at place -1

        byte = self.heads[context] & 255
        p = self.p0(T, *of(at0, self.c0, self.t0))
        p = _predict(*of(at1, self.c1, self.t1), T.c[1][byte], T.t[1][byte], 1, p)
        return _predict(*of(at2, self.c2, self.t2), T.c[2][context], T.t[2][context], 2, p)


def _predict(c, t, all_c, all_t, level, parent):
    d, s = DISCOUNT[level], STRENGTH[level]
    return (np.maximum(c - d * t, 0) + (s + d * all_t) * parent) / (s + all_c)


#: Contexts of each part that a bucket knows: keys, then their places among those of all buckets.
ASKS = "bucket int, part int, a binary"
#: Of one sweep: a bucket's seating (part -1), its sums of the contexts of each part, and (level given) its other sums.
SEATED = "bucket int, part int, a binary, b binary, c binary, level int, place int, c_sum double, t_sum double"
#: Totals of one part's contexts, for one bucket.
TOTALS = "bucket int, part int, a binary, b binary, c binary"


def _state(r: Restaurants, parts: int) -> pd.DataFrame:
    sums = r.sums()
    own = sums[sums["level"] == 2]
    c, t = np.zeros(len(r.keys)), np.zeros(len(r.keys))
    c[own["place"]], t[own["place"]] = own["c"], own["t"]
    out = [(r.bucket, -1, *(pack(x.astype(np.uint32)) for x in (r.t2, r.t1, r.t0)))]
    for j, at in enumerate(r.dealt(parts)):
        if len(at):
            out.append((r.bucket, j, None, pack(c[at].astype(np.int64)), pack(t[at].astype(np.int64))))
    above = sums[sums["level"] < 2].rename(columns={"c": "c_sum", "t": "t_sum"}).assign(bucket=r.bucket)
    columns = [x.split()[0] for x in SEATED.split(", ")]
    both = [pd.DataFrame(out, columns=columns[:5]).reindex(columns=columns), above.reindex(columns=columns)]
    return pd.concat([x.astype({k: "Int64" if k in ("bucket", "part", "level", "place") else "float64" if k.endswith("sum") else object
                                for k in columns}) for x in both])


def _dealt(keys: np.ndarray, parts: int) -> list[np.ndarray]:
    """Places of the contexts of each part."""
    part = (keys % np.uint64(parts)).astype(np.min_scalar_type(parts))
    by = np.argsort(part, kind="stable")
    return np.split(by, np.searchsorted(part[by], np.arange(1, parts)))


def _asks(row, parts: int) -> pd.DataFrame:
    keys = _risen(row["keys"])
    out = [(int(row["bucket"]), j, _rising(keys[at])) for j, at in enumerate(_dealt(keys, parts)) if len(at)]
    return pd.DataFrame(out, columns=["bucket", "part", "a"])


def _placed(asks: pd.DataFrame) -> pd.DataFrame:
    """One part: places of each bucket's contexts among those of all buckets, the same in every sweep."""
    keys = [_risen(a) for a in asks["a"]]
    every = _union(keys)
    return asks.assign(a=[_rising(np.searchsorted(every, k)) for k in keys])


def _total(asks: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
    """One part: customers and tables of its contexts over all buckets, sent back to each."""
    asks, own = asks.sort_values("bucket"), own.sort_values("bucket")
    places = [_risen(a).astype(np.int64) for a in asks["a"]]
    at = np.concatenate(places)
    c, t = (np.bincount(at, np.concatenate([unpack(x, np.int64) for x in own[k]])).astype(np.int64) for k in ("b", "c"))
    return pd.DataFrame({"bucket": own["bucket"].tolist(), "part": own["part"].tolist(), "a": None, "b": [pack(c[x]) for x in places],
                         "c": [pack(t[x]) for x in places]})


def _restored(r: Restaurants, above: list, rows: pd.DataFrame, parts: int) -> Totals:
    """Seat ``r`` as it was after a sweep; the totals after it."""
    T, dealt = Totals(above, len(r.keys)), r.dealt(parts)
    for part, a, b, c in zip(rows["part"].astype(int), rows["a"], rows["b"], rows["c"]):
        if part < 0:
            r.seated(*(unpack(x, np.uint32).astype(np.float64) for x in (a, b, c)))
        else:
            T.c[2][dealt[part]], T.t[2][dealt[part]] = unpack(b, np.int64), unpack(c, np.int64)
    return T


def in_rows(of):
    """``of`` every row, as a function of batches."""
    def run(batches):
        for pdf in batches:
            for _, row in pdf.iterrows():
                yield of(row)
    return run


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    spark = prepared(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(BUCKETS, -(-size // PER_BUCKET))
    # packed rows are large: one task for each bucket, later for each chunk; tokens go along (to as many tasks), so that no table
    # holds what is sent
    every = written(_sent(docs, buckets).repartition(2 * buckets, "bucket").groupBy("bucket").applyInPandas(_merge, LEARNED),
                    "lm-learned", by="tokens")
    tokens_of = every.where("tokens").select("chunk", "words", "many", "contexts")
    learned = every.where("not tokens and chunk is null").drop("tokens", "chunk", "words")
    asked = every.where("not tokens and chunk is not null").select("bucket", "chunk", "many", "contexts")
    size = learned.agg(F.sum("n_words").alias("v"), F.sum("n_tokens").alias("n"), F.sum("n_contexts").alias("c")).first()
    vocabulary, tokens = int(size["v"] or 0), int(size["n"] or 0)
    parts = -(-int(size["c"] or 1) // PER_PART)

    asks = written(learned.mapInPandas(in_rows(lambda row: _asks(row, parts)), ASKS)
                   .repartition(parts, "part").groupBy("part").applyInPandas(_placed, ASKS), "lm-asks")

    def after(state: DataFrame, name: str) -> tuple[list, DataFrame, DataFrame, list[DataFrame]]:
        """A sweep's sums of the restaurants above, its seatings, its totals; the tables that hold them."""
        state = written(state, f"lm-{name}")
        above = state.where("level is not null").groupBy("level", "place").agg(F.sum("c_sum"), F.sum("t_sum"))
        own = state.where("part >= 0").select("bucket", "part", "b", "c")
        totals = written(asks.repartition(parts, "part").groupBy("part").cogroup(own.repartition(parts, "part").groupBy("part"))
                         .applyInPandas(_total, TOTALS), f"lm-totals-{name}")
        return [tuple(x) for x in above.collect()], state.where("part = -1").select(*totals.columns), totals, [state, totals]  # 257 rows at most

    def sweep(k, above):
        def run(mine: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            r = Restaurants(mine.iloc[0], vocabulary)
            r.sweep(_restored(r, above, rows, parts), k)
            return _state(r, parts)
        return run

    above, seats, totals, old = after(
        learned.mapInPandas(in_rows(lambda row: _state(Restaurants(row, vocabulary), parts)), SEATED), "start")
    samples, known, kept = [], None, [asks]
    for k in range(SWEEPS):
        rows = seats.unionByName(totals).repartition(buckets, "bucket").groupBy("bucket")
        state = learned.repartition(buckets, "bucket").groupBy("bucket").cogroup(rows).applyInPandas(sweep(k, above), SEATED)
        last = old
        above, seats, totals, old = after(state, f"sweep-{k}")
        if k <= BURN_IN:
            drop_tables(*last)
        if k >= BURN_IN:
            kept += old
            own = seats.unionByName(totals).withColumn("sample", F.lit(len(samples)))
            samples.append(above)
            known = own if known is None else known.unionByName(own)

    def answer(mine: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(asked):
            return pd.DataFrame(columns=["chunk", "bucket", "p", "n"])
        r = Restaurants(mine[mine["sample"] < 0].iloc[0], vocabulary)
        pairs = r.place[r.of], r.at
        places, total = r.places(*pairs), np.zeros(len(r.of))
        for j, above in enumerate(samples):
            total += r.probability(_restored(r, above, mine[mine["sample"] == j], parts), *pairs, places)
        p = (total / len(samples)).astype("<f4")
        found = []
        for b, c in zip(asked["many"], asked["contexts"]):
            many, at = unpack(b, np.uint32).astype(np.int64), _stepped(c)
            n = r.count[r.of[at[np.cumsum(many) - many]]]  # of the word of its first pair
            found.append((_planes(p[at]), pack(n.astype(np.int64))))
        return pd.DataFrame({"chunk": asked["chunk"], "bucket": asked["bucket"], "p": [p for p, _ in found], "n": [n for _, n in found]})

    def gather(answers: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        cols = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        if not len(own):
            return pd.DataFrame(columns=cols)
        row = own.iloc[0]
        named, size, out, null = unpack(row["words"], np.int64).reshape(4, -1)
        of = _joined(row["contexts"], "<u4").astype(np.int64)
        answers = answers.sort_values("bucket")
        p = np.log10(np.concatenate([_joined(x, "<f4") for x in answers["p"]]).astype(np.float64))
        n = np.concatenate([unpack(x, np.int64) for x in answers["n"]])[unpack(row["many"], np.uint32)]
        base = np.log10((n + 1) / (tokens + vocabulary + 1))
        begin = np.cumsum(size) - size
        pdf = pd.DataFrame({"doc_id": named, "held_out": out > 0, "n_tokens": size,
                            "n_known": np.add.reduceat((n > 0).astype(np.int64)[of], begin), "train_tokens": tokens,
                            "base_score": np.add.reduceat(base[of], begin), "score": np.add.reduceat(p[of], begin)})
        pdf["doc_id"] = pdf["doc_id"].astype("Int64").mask(null > 0)
        return pdf

    chunks = max(1, tokens_of.count())
    mine = learned.withColumn("sample", F.lit(-1)).unionByName(known, allowMissingColumns=True)
    answers = written(mine.repartition(buckets, "bucket").groupBy("bucket")
                      .cogroup(asked.repartition(buckets, "bucket").groupBy("bucket"))
                      .applyInPandas(answer, "chunk string, bucket int, p binary, n binary"), "lm-answers")
    drop_tables(*kept)
    drop_tables(every, folder="tokens=false")
    return (answers.repartition(chunks, "chunk").groupBy("chunk")
            .cogroup(tokens_of.repartition(chunks, "chunk").groupBy("chunk"))
            .applyInPandas(gather, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                   "base_score double, score double"))
