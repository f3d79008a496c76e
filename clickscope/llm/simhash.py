"""SimHash near-dedup: tiled exact comparison of 64-bit fingerprints.

Fingerprint: words are lower-cased (A-Z) runs outside ``[\\x20\\x09-\\x0D]``;
every 4-word shingle, repeats included, is hashed with XXH64 (seed 42); a bit
is set when more than half of the hashes have it.

Comparison: equal fingerprints are one row (their smallest id is found before
the shuffle).  Distinct fingerprints are dealt by hash to strips of bounded
size, and each pair of strips is one task.  Inside it both strips are cut into
tiles of equal population counts of the two halves; a pair of tiles whose
counts differ by more than the radius cannot hold a link and is skipped, all
others are compared whole by exclusive-or and bit counts.  A task returns a
star per linked group, never all pairs of a group, so large groups of near
copies stay linear.  The comparison is exact: no link is lost, whatever the
size of a group.  Its work grows with the square of the distinct fingerprints.

Cases: a null or empty text (or one without a word) has fingerprint zero,
linked like any other; fewer words than a shingle are hashed whole; a null
doc_id takes part but never names a group (a group of null ids alone has a null
component_id); repeated rows and ids each get a row; an empty table gives an
empty table; only doc_id and text are read, other columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_tables, ROW, mix64, numbered, prepared, texts, written
from .components import components

SEED = 42
#: Fingerprints of one strip (8 bytes each in a task) and the fewest strips.
STRIP = 262_144
STRIPS = 12
#: Rows and columns of one exclusive-or.
ROWS, COLS = 256, 4096


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """Unsigned 64-bit SimHash of one whole text."""
    words = text.lower().split() if text else []
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n < shingle:
        h = np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
        starts = np.concatenate([[0], ends[:-1]])
        digest = xxhash.xxh64_intdigest
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(
            starts[:n - shingle + 1].tolist(), (ends[shingle - 1:] - 1).tolist())), np.uint64, n - shingle + 1)
    counts = np.zeros(64, np.int64)
    for k in range(0, len(h), 8192):
        part = h[k:k + 8192]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4, *keys: str) -> DataFrame:
    """(doc_id, keys, fp): the fingerprint as a signed long; ``keys`` are long columns carried along."""
    prepared(docs.sparkSession)

    def run(batches):
        for pdf in batches:
            fp = np.array([fingerprint(t, shingle) for t in pdf["text"].tolist()], dtype=np.uint64)
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), **{k: pdf[k] for k in keys}, "fp": fp.view(np.int64)})

    return texts(docs, *keys).mapInPandas(run, ", ".join(f"{c} long" for c in ("doc_id", *keys, "fp")))


def _roots(label: np.ndarray) -> np.ndarray:
    while True:
        up = label[label]
        if np.array_equal(up, label):
            return label
        label = up


def _join(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Merge the groups of x[k] and y[k] for every k; label points at a group's smallest index."""
    while True:
        a, b = label[x], label[y]
        differ = a != b
        if not differ.any():
            return label
        x, y, a, b = x[differ], y[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        label = _roots(label)


def tile_links(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, smallest of its group) among two strips, or in one (right None)."""
    low = np.uint64(0xFFFFFFFF)

    def tiled(f):
        f = np.unique(f)
        hi, lo = np.bitwise_count(f >> np.uint64(32)).astype(np.int64), np.bitwise_count(f & low).astype(np.int64)
        order = np.argsort(hi * 64 + lo, kind="stable")
        return f[order], (hi * 64 + lo)[order]

    a, ka = tiled(left)
    b, kb = (a, ka) if right is None else tiled(right)
    shift = 0 if right is None else len(a)
    label = np.arange(shift + len(b))
    tiles, first = np.unique(ka, return_index=True)
    last = np.append(first[1:], len(a))
    for key, i0, i1 in zip(tiles.tolist(), first.tolist(), last.tolist()):
        hi, lo = divmod(key, 64)
        for d in range(-radius, radius + 1):
            room = radius - abs(d)
            if not 0 <= hi + d <= 32 or right is None and d < 0:
                continue  # in one strip each pair of tiles is met once
            j0 = np.searchsorted(kb, (hi + d) * 64 + max(0, lo - room))
            j1 = np.searchsorted(kb, (hi + d) * 64 + min(32, lo + room), side="right")
            for i in range(i0, i1, ROWS):
                rows = a[i:min(i + ROWS, i1), None]
                for j in range(j0, j1, COLS):
                    near = np.bitwise_count(rows ^ b[None, j:min(j + COLS, j1)]) <= radius
                    if near.any():
                        x, y = np.nonzero(near)
                        label = _join(label, x + i, y + j + shift)
    nodes = a if right is None else np.concatenate([a, b])
    linked = np.flatnonzero(label != np.arange(len(label)))
    return nodes[linked], nodes[label[linked]]


def links(prints: DataFrame, radius: int = 4) -> DataFrame:
    """(u, v) stars over distinct fingerprints (column fp) within ``radius`` bits."""
    strips = max(STRIPS, -(-prints.count() // STRIP))

    # every strip meets every strip: a fingerprint goes to the tasks of its strip's pairs
    strip = F.pmod(F.xxhash64("fp"), F.lit(strips)).cast("int")
    dealt = (prints.select("fp", strip.alias("strip"))
             .select("fp", "strip", F.explode(F.sequence(F.lit(0), F.lit(strips - 1))).alias("other"))
             .select("fp", "strip", (F.least("strip", "other") * strips + F.greatest("strip", "other")).alias("pair")))

    def compare(key, pdf):
        i, j = divmod(int(key[0]), strips)
        fp, own = pdf["fp"].to_numpy().view(np.uint64), pdf["strip"].to_numpy()
        u, v = tile_links(fp[own == i], None if i == j else fp[own == j], radius)
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    return dealt.groupBy("pair").applyInPandas(compare, "u long, v long")


def _least(own: DataFrame, of: Column, radius: int) -> tuple[DataFrame, DataFrame]:
    """(fp, root) of every distinct fingerprint, and (root, least): the least ``of`` of every group."""
    prints = written(own.groupBy("fp").agg(F.min(of).alias("rep")), "simhash-distinct")
    star = components(links(prints, radius))
    grouped = written(prints.join(star, prints["fp"] == star["node"], "left")
                      .select("fp", "rep", F.coalesce("root", "fp").alias("root")), "simhash-root")
    least = written(grouped.groupBy("root").agg(F.min("rep").alias("least")), "simhash-group")
    drop_tables(prints)
    return grouped.select("fp", "root"), least


def near_groups(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest id reachable)."""
    own = written(fingerprints(docs, shingle), "simhash-fp")
    grouped, named = _least(own, F.col("doc_id"), radius)
    member = written(grouped.join(named, "root").select("fp", F.col("least").alias("component_id")), "simhash-member")
    return own.join(member, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """One row of ``docs`` of each near-copy group: the first of those with its smallest
    id, or, if no row of the group has an id, its first row.  Rows are told apart by a
    written number, so null and repeated ids are decided row by row."""
    rows = numbered(docs, "simhash-rows")
    flat = rows.select(ROW, F.col("doc")["doc_id"].alias("doc_id"), F.col("doc")["text"].alias("text"))
    own = written(fingerprints(flat, shingle, ROW), "simhash-fp")
    _, first = _least(own, F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(ROW)), radius)
    drop_tables(own)
    return rows.join(first.select(F.col(f"least.{ROW}").alias(ROW)), ROW, "left_semi").select("doc.*")
