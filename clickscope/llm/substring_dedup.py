"""Substring dedup by level-wise doubling.

The first level takes every window of 13 words of every whole text.  Windows that
repeat across documents, and no others, are extended to twice the length, the
repeated ones of these again, until no candidate survives: the last level
of a row tells how long its repeated passages are (``longest``).  A word goes
if a 13-word window over it also starts in a document with a smaller id.

Windows meet by hash.  A task reads its texts in chunks of bounded size, and each
chunk sends a window once, with the smallest document that has it, so
a window that very many documents hold is sent at most once a chunk.  Per bucket of
the hash one packed array goes over the network, and bits come back.  The bucket
comes from a second hash, so a first-level window is compared by 64 bits beside those
that its bucket fixes: their number grows with the corpus.  Words enter both by their
64-bit hashes, and a chunk tells its own windows apart by the 64 bits alone.  Levels above the
first take every place where both halves of the longer window repeat; no start is
left out.  A level keeps the hashes of its candidates alone, not the texts.

Cases: a null text counts as no words (its kept text is empty); texts under 13
words lose nothing; null ids come after all others; rows with the same id do not
remove each other's words; very long texts are a chunk of their own; an empty table
gives an empty table; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from itertools import count

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_tables, mix64, pack, prepared, texts, unpack, written

WINDOW = 13
#: Text bytes of one chunk; windows of one bucket.
CHUNK = 6_000_000
PER_BUCKET = 1_500_000
BUCKETS = 12
#: Candidates of one task on the levels above the first.
PER_TASK = 250_000
LAST = np.iinfo(np.int64).max
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Multiplier of the second hash, and its inverse modulo 2 ** 64.
_DEAL = 0xD1342543DE82EF95
_BACK = pow(_DEAL, -1, 1 << 64)


class Chunk:
    """Texts of one chunk, in order of their ids, as numbers of words."""

    def __init__(self, ids: np.ndarray, size: np.ndarray, code: np.ndarray, words: list[bytes]):
        self.ids, self.size, self.code, self.words = ids, size, code, words
        self.start = np.cumsum(size) - size

    @classmethod
    def of(cls, ids: list[int], raw: list[bytes]) -> Chunk:
        known: dict[bytes, int] = defaultdict(count().__next__)
        ids = np.array(ids, np.int64)
        order = np.argsort(ids, kind="stable")
        parts = [np.array(list(map(known.__getitem__, raw[k].split())), np.uint32) for k in order]
        return cls(ids[order], np.array([len(p) for p in parts], np.int64), np.concatenate(parts), list(known))

    def packed(self) -> tuple[bytes, bytes, bytes]:
        z = zstandard.ZstdCompressor(level=3)
        # numbers of words by their bytes, which pack better apart
        planes = self.code.astype("<u4").view(np.uint8).reshape(-1, 4).T
        return pack(np.stack([self.ids, self.size])), z.compress(b" ".join(self.words)), z.compress(np.ascontiguousarray(planes).tobytes())

    @classmethod
    def opened(cls, head: bytes, words: bytes, code: bytes) -> Chunk:
        ids, size = unpack(head, np.int64).reshape(2, -1)
        words = zstandard.ZstdDecompressor().decompress(words)
        code = np.ascontiguousarray(unpack(code, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)
        return cls(ids, size, code, words.split(b" ") if words else [])

    def level(self, window: int = WINDOW) -> Level:
        """Its windows of the first level; they do not cross texts."""
        word = np.fromiter((xxhash.xxh64_intdigest(w) for w in self.words), np.uint64, len(self.words))
        w = word[self.code]
        last = np.repeat(self.start + self.size - window, self.size)
        at = np.flatnonzero(np.arange(len(w)) <= last)
        h = np.zeros(max(0, len(w) - window + 1), np.uint64)
        for k in range(window):  # a polynomial of the word hashes, made even by the finaliser
            h = h * _STEP + w[k:k + len(h)]
        doc = np.repeat(np.arange(len(self.ids)), self.size)[at]
        return Level(at, doc, mix64(h)[at], self.ids, _dealing(w, window)[at])


def _dealing(w: np.ndarray, window: int) -> np.ndarray:
    """A second hash of every window, independent of the first: differences of one running polynomial."""
    with np.errstate(over="ignore"):
        power = np.multiply.accumulate(np.full(len(w), _DEAL, np.uint64))
        back = np.multiply.accumulate(np.full(len(w), _BACK, np.uint64))
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(w ^ _STEP) * power)])
        n = max(0, len(w) - window + 1)
        return mix64((run[window:window + n] - run[:n]) * back[:n])


class Level:
    """Candidate windows of one chunk and one length: place of each in the chunk, number of its text, hash, and
    the hash that deals it to a bucket (of longer levels: of the first hash)."""

    def __init__(self, at: np.ndarray, doc: np.ndarray, hash: np.ndarray, ids: np.ndarray, deal: np.ndarray | None = None):
        self.at, self.doc, self.hash, self.ids = at, doc, hash, ids
        self.deal = mix64(hash) if deal is None else deal

    @classmethod
    def opened(cls, head: bytes, place: bytes, body: bytes) -> Level:
        doc, n, ids = unpack(head, np.int64).reshape(3, -1)
        of = np.full(int(doc.max()) + 1, LAST)
        of[doc] = ids
        return cls(np.cumsum(unpack(place, np.int64)), np.repeat(doc, n), np.frombuffer(body, np.uint64), of)

    def packed(self) -> tuple[bytes, bytes, bytes]:
        doc, n = np.unique(self.doc, return_counts=True)
        return pack(np.stack([doc, n, self.ids[doc]])), pack(np.diff(self.at, prepend=0)), self.hash.tobytes()

    def entries(self, buckets: int):
        """Distinct windows in order of (bucket, document): places in ``at``, bucket of each, and
        for each window its entry."""
        order = np.argsort(self.hash)
        h = self.hash[order]
        begin = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])[:len(h)])
        if not len(begin):
            return order, order, order
        entry = np.empty(len(h), np.int64)
        entry[order] = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(h))))
        first = np.minimum.reduceat(order, begin)  # the smallest document: documents ascend
        bucket = (self.deal[first] % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(bucket * len(h) + first)
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        return first[by], bucket[by], place[entry]

    def sent(self, name: str, buckets: int) -> pd.DataFrame:
        first, bucket, _ = self.entries(buckets)
        cut = np.searchsorted(bucket, np.arange(buckets + 1))
        rows = []
        for b in np.flatnonzero(np.diff(cut)).tolist():
            own = first[cut[b]:cut[b + 1]]
            docs_of, n = np.unique(self.doc[own], return_counts=True)
            rows.append((name, b, pack(np.stack([self.ids[docs_of], n])), self.hash[own].tobytes()))
        return pd.DataFrame(rows, columns=["chunk", "bucket", "head", "body"])

    def verdicts(self, bits: pd.DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """For each window, whether a smaller, and whether any other, document has it."""
        first, bucket, entry = self.entries(buckets)
        smaller, other = np.zeros(len(first), bool), np.zeros(len(first), bool)
        edge = np.searchsorted(bucket, np.arange(buckets + 1))
        for b, packed in zip(bits["bucket"].tolist(), bits["bits"]):
            n = edge[b + 1] - edge[b]
            got = np.unpackbits(unpack(packed, np.uint8).reshape(2, -1), axis=1, count=int(n)).astype(bool)
            smaller[edge[b]:edge[b + 1]], other[edge[b]:edge[b + 1]] = got
        head_id, mine = self.ids[self.doc[first]], self.ids[self.doc]
        most = np.full(len(first), np.iinfo(np.int64).min)
        np.maximum.at(most, entry, mine)
        return smaller[entry] | (head_id[entry] < mine), (other | (most > head_id))[entry]

    def doubled(self, repeated: np.ndarray, half: int) -> Level:
        """Windows of twice the length ``half`` whose halves both repeat, at every place."""
        at, doc, h = self.at[repeated], self.doc[repeated], self.hash[repeated]
        if not len(at):
            return Level(at, doc, h, self.ids)
        then = np.minimum(np.searchsorted(at, at + half), len(at) - 1)
        both = (at[then] == at + half) & (doc[then] == doc)
        return Level(at[both], doc[both], mix64(h[both] * _STEP ^ h[then[both]]), self.ids)


def _chunks(docs: DataFrame) -> DataFrame:
    """(chunk, head, words, code): ids and sizes, different words, and word numbers of texts of
    CHUNK bytes or of one longer text.  Texts are split into words here and nowhere else."""
    def emit(name, ids, raw):
        return pd.DataFrame([(name, *Chunk.of(ids, raw).packed())], columns=["chunk", "head", "words", "code"])

    def run(batches):
        task, k = TaskContext.get().partitionId(), 0
        ids, raw, size = [], [], 0
        for pdf in batches:
            null = pdf["doc_id"].isna().to_numpy()
            for i, t, no in zip(pdf["doc_id"].tolist(), pdf["text"].tolist(), null.tolist()):
                t = t or b""
                if ids and size + len(t) > CHUNK:
                    yield emit(f"{task}-{k}", ids, raw)
                    ids, raw, size, k = [], [], 0, k + 1
                ids.append(LAST if no else int(i))
                raw.append(t)
                size += len(t)
        if ids:
            yield emit(f"{task}-{k}", ids, raw)

    return texts(docs).mapInPandas(run, "chunk string, head binary, words binary, code binary")


def _sent(chunks: DataFrame, buckets: int) -> DataFrame:
    """(chunk, bucket, head, body): the distinct windows of a chunk by bucket, their documents and hashes."""
    def run(batches):
        for pdf in batches:
            for name, *packed in zip(pdf["chunk"], pdf["head"], pdf["words"], pdf["code"]):
                yield Chunk.opened(*packed).level().sent(name, buckets)

    return chunks.mapInPandas(run, "chunk string, bucket int, head binary, body binary")


def _sent_level(levels: DataFrame, buckets: int) -> DataFrame:
    """As ``_sent``, of the candidates of a longer level."""
    def run(batches):
        for pdf in batches:
            for name, *packed in zip(pdf["chunk"], pdf["head"], pdf["place"], pdf["body"]):
                yield Level.opened(*packed).sent(name, buckets)

    return levels.mapInPandas(run, "chunk string, bucket int, head binary, body binary")


def _meet(pdf: pd.DataFrame) -> pd.DataFrame:
    """One bucket: for each window sent, whether a smaller, and whether any other, document has it."""
    doc, sizes = [], []
    for head in pdf["head"]:
        ids, n = unpack(head, np.int64).reshape(2, -1)
        doc.append(np.repeat(ids, n))
        sizes.append(int(n.sum()))
    doc = np.concatenate(doc)
    h = np.concatenate([np.frombuffer(b, np.uint64) for b in pdf["body"]])
    order = np.argsort(h, kind="stable")
    h, d = h[order], doc[order]
    begin = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    run = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(h))))
    least, most = np.minimum.reduceat(d, begin)[run], np.maximum.reduceat(d, begin)[run]
    smaller, other = np.empty(len(h), bool), np.empty(len(h), bool)
    smaller[order], other[order] = least < d, least < most
    cut = np.cumsum([0, *sizes])
    return pd.DataFrame({"chunk": pdf["chunk"], "bucket": pdf["bucket"],
                         "bits": [pack(np.packbits(np.stack([smaller[a:b], other[a:b]]), axis=1)) for a, b in zip(cut, cut[1:])]})


#: Rows of texts (no ``n``), of texts that a level was reached in (``longest`` alone), and
#: of a chunk's ``n`` candidates for the next level.
FOUND = ("chunk string, row long, doc_id long, n_words long, n_removed long, kept_sha256 string, kept string, "
         "longest long, n long, head binary, place binary, body binary")
_COLUMNS = [x.split()[0] for x in FOUND.split(", ")]


def _frame(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame(rows).reindex(columns=_COLUMNS).astype(
        {k: "Int64" if k in ("row", "doc_id", "n_words", "n_removed", "longest", "n") else object for k in _COLUMNS})


def _next(name: str, level: Level) -> list[dict]:
    return [{"chunk": name, "n": len(level.at), **dict(zip(("head", "place", "body"), level.packed()))}] if len(level.at) else []


def _judge(bits: pd.DataFrame, text: pd.DataFrame, buckets: int, keep_text: bool) -> pd.DataFrame:
    rows = []
    for name, *packed in zip(text["chunk"], text["head"], text["words"], text["code"]):
        c = Chunk.opened(*packed)
        level = c.level()
        gone, repeated = level.verdicts(bits, buckets)
        cover = np.zeros(len(c.code) + 1, np.int64)
        np.add.at(cover, level.at[gone], 1)
        np.add.at(cover, level.at[gone] + WINDOW, -1)
        cover = np.cumsum(cover[:-1]) > 0
        some = np.bincount(level.doc[repeated], minlength=len(c.ids)) > 0
        for k, i in enumerate(c.ids.tolist()):
            text_of = slice(c.start[k], c.start[k] + c.size[k])
            own = cover[text_of]
            kept = b" ".join([c.words[w] for w in c.code[text_of][~own].tolist()])
            rows.append({"chunk": name, "row": k, "doc_id": None if i == LAST else i, "n_words": len(own), "n_removed": int(own.sum()),
                         "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept.decode() if keep_text else None,
                         "longest": WINDOW if some[k] else 0})
        rows += _next(name, level.doubled(repeated, WINDOW))
    return _frame(rows)


def _judge_level(buckets: int, length: int):
    def judge(bits: pd.DataFrame, level: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for name, *packed in zip(level["chunk"], level["head"], level["place"], level["body"]):
            own = Level.opened(*packed)
            _, repeated = own.verdicts(bits, buckets)
            rows += [{"chunk": name, "row": k, "longest": length} for k in np.unique(own.doc[repeated]).tolist()]
            rows += _next(name, own.doubled(repeated, length))
        return _frame(rows)

    return judge


def _met(sent: DataFrame, buckets: int, by_chunk: DataFrame, chunks: int, judge) -> DataFrame:
    """``judge`` of (bits, rows) of each chunk, after its windows met those of all others."""
    # tasks are numbered here: packed rows are few and large, so they must not be coalesced by their count
    bits = sent.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(_meet, "chunk string, bucket int, bits binary")
    return (bits.repartition(chunks, "chunk").groupBy("chunk").cogroup(by_chunk.repartition(chunks, "chunk").groupBy("chunk"))
            .applyInPandas(judge, FOUND))


def _double(found: DataFrame) -> DataFrame:
    """(chunk, row, longest): the windows of 26, 52, ... words that repeat, level by level."""
    done, length = None, WINDOW
    while True:
        length *= 2
        levels = found.where("n is not null").select("chunk", "n", "head", "place", "body")
        size = levels.agg(F.count("*").alias("chunks"), F.sum("n").alias("n")).first()
        if not size["chunks"]:
            break
        # few candidates are few tasks, whatever the number of chunks that they come from
        buckets = max(1, -(-size["n"] // PER_TASK))
        found = written(_met(_sent_level(levels, buckets), buckets, levels, min(size["chunks"], buckets), _judge_level(buckets, length)),
                        "substring-level")
        got = found.where("n is null").select("chunk", "row", "longest")
        done = got if done is None else done.unionByName(got)
    if done is None:
        return found.where("false").select("chunk", "row", "longest")
    return done.groupBy("chunk", "row").agg(F.max("longest").alias("longest"))


def dedup(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, longest (and the kept text with ``keep_text``)."""
    prepared(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(BUCKETS, -(-size // (6 * PER_BUCKET)))  # about six bytes a word
    chunks = written(_chunks(docs), "substring-chunks")

    def judge(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return _judge(a, b, buckets, keep_text)

    found = written(_met(_sent(chunks, buckets), buckets, chunks, max(1, chunks.count()), judge), "substring-found")
    drop_tables(chunks)
    own = found.where("n is null")
    longest = written(_double(found), "substring-longest").withColumnRenamed("longest", "__longest")
    cols = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept"] * keep_text
    return own.join(longest, ["chunk", "row"], "left").select(
        *cols, F.coalesce("__longest", "longest").cast("long").alias("longest"))


ORACLE = f"""
with recursive d as (select row_number() over () as r, doc_id, coalesce(doc_id, {LAST}) as id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as ws from documents),
w as (select r, id, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') as s from d, unnest(generate_series(1, len(ws) - {WINDOW - 1})) u(i)),
f as (select s, min(id) as m, max(id) as most from w group by s),
lv(n, r, id, i, h) as (
  select {WINDOW}, r, id, i, md5(s) from w join f using (s) where m < most
  union all
  select n, r, id, i, h from (
    select 2 * a.n as n, a.r, a.id, a.i, md5(a.h || b.h) as h, min(a.id) over same as lo, max(a.id) over same as hi
    from lv a join lv b on a.r = b.r and b.i = a.i + a.n window same as (partition by md5(a.h || b.h))) where lo < hi),
lo as (select r, max(n)::bigint as longest from lv group by r),
g as (select distinct r, unnest(generate_series(i, i + {WINDOW - 1})) as p from w join f using (s) where m < id),
k as (select d.r, u.p, d.ws[u.p] as word, g.p is not null as gone
      from d, unnest(generate_series(1, len(ws))) u(p) left join g on g.r = d.r and g.p = u.p),
a as (select r, count(*) filter (gone) as n_removed, coalesce(string_agg(word, ' ' order by p) filter (not gone), '') as kept from k group by r)
select doc_id, len(ws) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256,
  coalesce(longest, 0) as longest
from d left join a using (r) left join lo using (r)
"""
