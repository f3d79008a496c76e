"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

An item of n words matches where a text holds a passage within
``floor(MAX_EDIT * n)`` word edits of it.  Windows as long as the items are slid
over whole texts.  The CGK random walk turns a window of words into a
longer string: at step j it writes the word under its pointer, and the pointer
moves on if a random bit of (j, word) is one; a small edit distance becomes a
small Hamming distance, as walks meet again after an edit.  Each of ``TABLES``
hashes samples ``SAMPLED`` places of one of ``WALKS`` walks (many repeats reach
the target recall); windows and items with an equal hash are candidates, and
the exact edit distance of the item against the passage and its surroundings
decides.  Only verified matches are returned.

Windows that cannot match need no walk: within k edits (and k words cut at the
end) an item keeps at least n - q + 1 - (q + 1) k of its q-word runs, so
windows with fewer runs of items of that length are passed over.  The test is
exact and loses nothing.

The items are taken in blocks of at most about ``BLOCK_BYTES`` text (each block is
sent to all tasks); the texts are read once per block.

Words are lower-cased runs of word characters.  Cases: null or wordless items
match nothing, null or empty texts hold nothing; items with equal texts are
each reported; repeated rows and ids are reported once per (doc_id, item_id), at
the fewest edits and then the first place; null doc_ids are reported as null; an
empty table on either side gives an empty table; only doc_id, text and
item_id, text are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, mix64, numbered, prepared

MAX_EDIT = 0.2
WALKS, TABLES_PER_WALK, SAMPLED = 8, 4, 3
BLOCK_BYTES = 2_000_000
#: Windows embedded at once by one task.
AT_ONCE = 4000
#: Letters, digits and the marks that belong to letters (vowel signs of many scripts).
_words = regex.compile(r"[\w\p{M}]+").findall


def words(text: str | None) -> list[str]:
    return _words(text.lower()) if text else []


def edits(pattern: list[int], region: list[int]) -> tuple[int, int]:
    """Fewest word edits between ``pattern`` and any run of ``region``, and the end of
    the first such run (bit-parallel dynamic programming)."""
    n = len(pattern)
    full, high = (1 << n) - 1, 1 << (n - 1)
    at: dict[int, int] = {}
    for k, w in enumerate(pattern):
        at[w] = at.get(w, 0) | 1 << k
    up, down, score = full, 0, n
    best, end = n, 0
    for j, w in enumerate(region):
        eq = at.get(w, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph, mh = down | ~(xh | up) & full, up & xh
        score += bool(ph & high) - bool(mh & high)
        ph, mh = ph << 1 & full, mh << 1 & full
        up, down = mh | ~(xv | ph) & full, ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


def embed(x: np.ndarray, walk: int, steps: int) -> np.ndarray:
    """CGK walk: (rows, steps) words written; ``x`` (rows, width) ends in zeros."""
    rows = np.arange(len(x))
    place = np.zeros(len(x), np.int64)
    out = np.empty((len(x), steps), np.uint64)
    last = x.shape[1] - 1
    for j in range(steps):
        w = x[rows, place]
        out[:, j] = w
        key = np.uint64((walk * 1_000_003 + j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        place = np.minimum(place + (mix64(w ^ key) & np.uint64(1)).astype(np.int64), last)
    return out


def signatures(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """(tables, rows) hashes of windows ``x`` of lengths ``n``: sampled places of the walks."""
    g = np.random.default_rng(5)
    steps = 2 * int(n.max())
    sig = []
    for walk in range(WALKS):
        e = embed(x, walk, steps)
        for t in range(TABLES_PER_WALK):
            h = mix64(n.astype(np.uint64) + np.uint64(1000 * walk + t))
            for f in g.random(SAMPLED):  # a place of the first 2n, where the walk is still inside the window
                h = mix64(h ^ np.take_along_axis(e, (f * 2 * n).astype(np.int64)[:, None], 1)[:, 0])
            sig.append(h)
    return np.stack(sig)


class Items:
    """A block of benchmark items: word runs, hash tables, and the words themselves."""

    def __init__(self, rows: list[tuple[int, list[str]]]):
        self.rows = rows = [(i, w) for i, w in rows if w]
        self.known: dict[str, int] = {}
        self.words = [[self.known.setdefault(w, len(self.known) + 1) for w in ws] for _, ws in rows]
        self.size = np.array([len(w) for w in self.words], np.int64)
        self.most = np.floor(MAX_EDIT * self.size + 1e-9).astype(np.int64)
        self.hash = np.zeros(len(self.known) + 2, np.uint64)
        for w, k in self.known.items():
            self.hash[k] = xxhash.xxh64_intdigest(w.encode()) | 1
        # of each length: its edits, run length q and the fewest runs kept
        self.lengths = []
        for n in sorted(set(self.size.tolist())):
            k = int(np.floor(MAX_EDIT * n + 1e-9))
            q = next((q for q in (3, 2) if n - q + 1 - (q + 1) * k >= 1), 1)
            self.lengths.append((n, k, q, max(1, n - q + 1 - (q + 1) * k)))
        self.runs = {}  # q -> sorted run codes, and for each the lengths that have it
        for q in (1, 2, 3):
            found: dict[int, set[int]] = {}
            for c, (n, _, own, _) in enumerate(self.lengths):
                if own == q:
                    for w in (w for w in self.words if len(w) == n):
                        for code in self.codes(np.array(w, np.int64), q).tolist():
                            found.setdefault(code, set()).add(c)
            if found:
                order = sorted(found)
                pairs = [(k, c) for k, code in enumerate(order) for c in sorted(found[code])]
                first = np.searchsorted([p[0] for p in pairs], np.arange(len(order) + 1))
                self.runs[q] = np.array(order, np.int64), first, np.array([p[1] for p in pairs], np.int64)
        width = int(self.size.max()) + 1 if len(rows) else 1
        x = np.zeros((len(rows), width), np.uint64)
        for k, w in enumerate(self.words):
            x[k, :len(w)] = self.hash[w]
        self.tables = []
        if len(rows):
            for h in signatures(x, self.size):
                order = np.argsort(h, kind="stable")
                self.tables.append((h[order], order))

    def codes(self, w: np.ndarray, q: int) -> np.ndarray:
        """One number per q-word run of known words (words are 1 ..; 0 is unknown)."""
        base = len(self.known) + 1
        if q == 1:
            return w
        if base ** q < 1 << 62:
            return w[:-1] * base + w[1:] if q == 2 else (w[:-2] * base + w[1:-1]) * base + w[2:]
        parts = [w[k:len(w) - q + 1 + k].astype(np.uint64) for k in range(q)]
        h = parts[0]
        for p in parts[1:]:
            h = mix64(h) ^ p
        return (h >> np.uint64(1)).astype(np.int64)

    def windows(self, w: np.ndarray) -> list[tuple[int, int]]:
        """(start, length) of the windows of one or more texts that keep enough runs."""
        out = set()
        for q, (order, first, lengths) in self.runs.items():
            if len(w) < q:
                continue
            code = self.codes(w, q)
            k = np.minimum(np.searchsorted(order, code), len(order) - 1)
            hit = np.flatnonzero((order[k] == code) & (w[:len(code)] > 0))
            if not len(hit):
                continue
            n_of = first[k[hit] + 1] - first[k[hit]]
            at = np.repeat(hit, n_of)  # a place for each length that has its run
            begin = np.repeat(first[k[hit]], n_of) + np.arange(n_of.sum()) - np.repeat(np.cumsum(n_of) - n_of, n_of)
            own = lengths[begin]
            by = np.argsort(own, kind="stable")
            at, own = at[by], own[by]
            cut = np.searchsorted(own, np.arange(len(self.lengths) + 1))
            for c in np.flatnonzero(np.diff(cut)).tolist():
                n, _, _, need = self.lengths[c]
                p = at[cut[c]:cut[c + 1]]
                if len(p) < need:
                    continue
                a, b = p[:len(p) - need + 1], p[need - 1:]
                for i in np.flatnonzero(b - a <= n - q).tolist():
                    for s in range(int(b[i]) - (n - q), int(a[i]) + 1):
                        out.add((s, n))
        return sorted(out)


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_words (of the item), edits, end_word: the verified passages."""
    spark = prepared(docs.sparkSession)
    schema = "doc_id long, item_id long, n_words int, edits int, end_word int"
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    out = None
    for block in range(blocks):
        of = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = [(r["item_id"], words(r["text"])) for r in of.select("item_id", "text").collect()]  # about BLOCK_BYTES
        sent = spark.sparkContext.broadcast(Items(sorted(rows, key=lambda r: (r[0] is None, r[0], r[1]))))
        found = docs.select("doc_id", "text").mapInPandas(_search(sent), schema)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], schema)
    w = F.min(F.struct("edits", "end_word")).alias("m")
    return (out.groupBy("doc_id", "item_id", "n_words").agg(w)
            .select("doc_id", "item_id", "n_words", "m.edits", "m.end_word"))


def _search(sent):
    def run(batches):
        held = Held(sent.value)
        for pdf in batches:
            for doc_id, text in zip(pdf["doc_id"].tolist(), pdf["text"].tolist()):
                held.add(doc_id, text)
                if held.size >= AT_ONCE:
                    yield held.found()
        yield held.found()
    return run


class Held:
    """Windows of texts read so far that still have to be embedded and verified."""

    def __init__(self, items: Items):
        self.items = items
        self.clear()

    def clear(self):
        self.size, self.docs, self.at = 0, [], []

    def add(self, doc_id, text) -> None:
        it = self.items
        if not it.rows:
            return
        w = np.array([it.known.get(x, 0) for x in words(text)], np.int64)
        # a window may begin or end outside the text: matches at its ends count
        pad = max(n for n, *_ in it.lengths)
        got = it.windows(w) if len(w) else []
        for s, n in got:
            self.at.append((len(self.docs), s, n))
        if got:
            self.docs.append((doc_id, np.concatenate([np.zeros(pad, np.int64), w, np.zeros(pad, np.int64)]), pad))
            self.size += len(got)

    def found(self) -> pd.DataFrame:
        it, best = self.items, {}
        for k in range(0, len(self.at), AT_ONCE):
            self._verify(self.at[k:k + AT_ONCE], best)
        rows = [(self.docs[d][0], it.rows[i][0], int(it.size[i]), e, end) for (d, i), (e, end) in best.items()]
        self.clear()
        out = pd.DataFrame(rows, columns=["doc_id", "item_id", "n_words", "edits", "end_word"])
        return out.astype({"doc_id": "Int64", "item_id": "Int64", "n_words": "int32", "edits": "int32", "end_word": "int32"})

    def _verify(self, at: list[tuple[int, int, int]], best: dict) -> None:
        it = self.items
        n = np.array([x[2] for x in at], np.int64)
        x = np.zeros((len(at), int(n.max()) + 1), np.uint64)
        for r, (d, s, size) in enumerate(at):
            _, w, pad = self.docs[d]
            x[r, :size] = it.hash[w[s + pad:s + pad + size]]
        pairs: set[tuple[int, int]] = set()
        for h, (order, item) in zip(signatures(x, n), it.tables):
            a, b = np.searchsorted(order, h), np.searchsorted(order, h, side="right")
            for r in np.flatnonzero(b > a).tolist():
                pairs.update((r, i) for i in item[a[r]:b[r]].tolist())
        seen = set()
        for r, i in sorted(pairs):
            d, s, size = at[r]
            k = int(it.most[i])
            if int(it.size[i]) != size or (d, i, s // (k + 1)) in seen:
                continue
            _, w, pad = self.docs[d]
            lo = max(0, s + pad - 2 * k)
            e, end = edits(it.words[i], w[lo:s + pad + size + 2 * k].tolist())
            if e <= k:
                seen.add((d, i, s // (k + 1)))
                now = e, lo + end - pad
                best[d, i] = min(best.get((d, i), now), now)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a benchmark passage; null and repeated ids are decided row by row."""
    rows = numbered(docs, "decontamination-rows")
    bad = matches(rows.select(F.col(ROW).alias("doc_id"), F.col("doc")["text"].alias("text")), benchmark).select(F.col("doc_id").alias(ROW)).distinct()
    return rows.join(bad, ROW, "left_anti").select("doc.*")
