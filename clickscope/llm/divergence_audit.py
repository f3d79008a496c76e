"""Source divergence audit by Gustavson's row accumulation.

Groups are the (lang, source) pairs.  With p the share of a term in a group (in 1e9ths,
one added to every count) and q its share elsewhere, a term adds f = (p - q)^2 / q.
For each group the sum over all kept terms against every other source of its
language is a row of a product of sparse matrices, so it is made as one:

* *Baselines* (``_baselines``): the row as if no peer, then as if the group itself, had
  any term.  A term's share depends on its count alone, so a histogram of counts
  for each group is enough, whatever the vocabulary.
* *Accumulation* (``_scattered``): terms are dealt to buckets.  In a bucket the
  term-major index holds for each term the groups that have it; each group walks its
  terms, and each index row is added to a dense accumulator with one place for
  every peer.  What is added corrects the zero baselines, so terms that only
  one side has cost nothing here and no pair of postings is ever emitted.

Terms are counted in tasks (occurrences and documents) and summed by Spark, so a
group with a third of all rows arrives as counts.  Shares are exact: decimals
where counts are scaled, 64-bit integers after that (f is at most 1e18 and the sums of
a row stay near that while a language keeps less than 1e9 terms).

Cases: null text, lang and source are read as ''; every row is a document, repeated
ids and rows included; a group without terms has a row for each other source; a language of one source
has no ``pair`` rows; ties of values go by the item's UTF-8 bytes; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prepared, written

SCALE = 1_000_000_000
#: Entries (group, term) of one bucket of terms.
ENTRIES = 1 << 18
#: Entries that a counting task holds before it sends them on.
FLUSH = 1 << 19
#: Groups whose baselines are made together.
ROWS = 16
#: Numbers held at once while a histogram meets the peers.
CELLS = 1 << 18

_KEPT = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
GROUP = ("lang", "source")
#: A document in the packed counts of a task, which sees less than 2^23 documents and 2^40 words between flushes.
ONE_DOC = 1 << 40


def terms(text: bytes) -> list[bytes]:
    return text.translate(_KEPT).split(b" ") if text else []


def counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, count, n_docs), and a row with term '' for every group."""
    prepared(docs.sparkSession)

    def run(batches):
        total: dict = {}  # (lang, source) -> term -> occurrences and, above 40 bits, documents
        size = 0

        def flush():
            for (lang, source), n in total.items():
                both = np.array([0, *n.values()], np.int64)
                yield pd.DataFrame({"lang": lang, "source": source, "term": [b"", *n], "count": both & (ONE_DOC - 1),
                                    "n_docs": both >> 40})

        for pdf in batches:
            for lang, source, text in zip(pdf["lang"], pdf["source"], pdf["text"], strict=True):
                n = total.setdefault((lang, source), {})
                had, get = len(n), n.get
                own = Counter(terms(text))
                own.pop(b"", None)
                for term, k in own.items():
                    n[term] = get(term, 0) + k + ONE_DOC
                size += len(n) - had
                if size > FLUSH:
                    yield from flush()
                    total, size = {}, 0
        yield from flush()

    empty = F.lit("")
    rows = docs.select(F.coalesce("lang", empty).alias("lang"), F.coalesce("source", empty).alias("source"),
                       F.coalesce(F.col("text"), empty).cast("binary").alias("text"))
    out = rows.mapInPandas(run, "lang string, source string, term binary, count long, n_docs long")
    return (out.groupBy("lang", "source", F.col("term").cast("string").alias("term"))
            .agg(F.sum("count").alias("count"), F.sum("n_docs").alias("n_docs")))


def _share(count: str, n: str) -> str:
    """1 + floor(SCALE * (count + 1) / (n + v)) in SQL, exact."""
    return f"1 + (cast({count} + 1 as decimal(19, 0)) * {SCALE}) div cast({n} + v as decimal(20, 0))"


def _f(p, q):
    d = p - q
    return d * d // q


class Audit:
    """The tables that both parts use; each is written once in the shared folder."""

    def __init__(self, docs: DataFrame, min_docs: int = 3):
        own = Window.partitionBy("lang", "term")
        all_ = written(counts(docs), "audit-counts")
        found = all_.where("term != ''").select(
            *GROUP, "term", "count", F.sum("count").over(own).alias("lang_count"), F.sum("n_docs").over(own).alias("in_docs"),
            (F.min("source").over(own) == F.col("source")).cast("long").alias("first"))
        #: (lang, source, term, count, lang_count, first) of the kept terms
        self.kept = written(found.where(F.col("in_docs") >= min_docs).drop("in_docs"), "audit-kept")
        sums = self.kept.groupBy(*GROUP).agg(F.sum("count").alias("n"), F.count("*").alias("has"), F.sum("first").alias("firsts"))
        names = all_.where("term = ''").select(*GROUP)
        zero = F.lit(0).cast("long")
        lang = Window.partitionBy("lang")
        groups = names.join(sums, list(GROUP), "left").select(
            *GROUP, F.coalesce("n", zero).alias("n"), F.coalesce("has", zero).alias("has"),
            F.coalesce(F.sum("firsts").over(lang), zero).alias("v"), F.coalesce(F.sum("n").over(lang), zero).alias("lang_n"),
            (F.row_number().over(lang.orderBy("source")) - 1).alias("sid"), F.count("*").over(lang).alias("peers"))
        # a language without kept terms has no share to be scaled
        self.groups = written(groups.withColumn("p0", F.expr(f"case when v > 0 then {_share('0L', 'n')} else 1L end")), "audit-groups")

    def entries(self) -> DataFrame:
        """Kept (lang, source, term, count) with the group's numbers and the share p."""
        mine = self.groups.select(*GROUP, "n", "v", "lang_n", "sid", "p0", "peers")
        return self.kept.join(mine, list(GROUP)).withColumn("p", F.expr(_share("count", "n")))


def _vector(pdf: pd.DataFrame) -> np.ndarray:
    """p0 of every source of a language by number."""
    out = np.ones(int(pdf["peers"].iloc[0]), np.int64)
    out[pdf["sid"].to_numpy()] = pdf["p0"].to_numpy()
    return out


def _pairs(lang: str, a: np.ndarray, b: np.ndarray, value: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"lang": lang, "a": a.astype(np.int32), "b": b.astype(np.int32), "value": value})


_PAIRS = "lang string, a int, b int, value long"


def _baselines(audit: Audit) -> DataFrame:
    """(lang, a, b, value): what ``a`` has over an empty ``b``, and what an empty ``a`` has over
    ``b`` beyond that: every term that one of them lacks is right, those of both are not yet."""
    g = audit.groups
    block = F.expr(f"sid div {ROWS}").alias("block")
    # the histogram of a group; terms that it lacks count 0
    hist = (audit.entries().groupBy("lang", "sid", "p", "p0").agg(F.count("*").alias("times"))
            .unionByName(g.select("lang", "sid", F.col("p0").alias("p"), "p0", (F.col("v") - F.col("has")).alias("times")))
            .select("lang", block, "sid", "p", "p0", "times"))
    hist = written(hist, "audit-histograms")
    peers = g.select("lang", "sid", "p0", "peers", F.explode(F.expr(f"sequence(0, (peers - 1) div {ROWS})")).alias("block"))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        lang, q0 = right["lang"].iloc[0], _vector(right)
        out = [_pairs(lang, np.empty(0), np.empty(0), np.empty(0, np.int64))]
        step = max(1, CELLS // len(q0))
        everyone = np.arange(len(q0))
        for sid, mine in left.groupby("sid", sort=False):
            p, times, p0 = (mine[c].to_numpy(np.int64) for c in ("p", "times", "p0"))
            over, under = np.zeros((2, len(q0)), np.int64)
            for at in range(0, len(p), step):
                pc, tc = p[at:at + step, None], times[at:at + step, None]
                over += (tc * _f(pc, q0)).sum(0)
                # terms that the group has, as the peers that lack them see them
                under += (tc * (_f(q0, pc) - _f(q0, p0[:1]))).sum(0)
            other = everyone != sid
            me = np.full(other.sum(), sid)
            out += [_pairs(lang, me, everyone[other], over[other]), _pairs(lang, everyone[other], me, under[other])]
        return pd.concat(out)

    return hist.groupBy("lang", "block").cogroup(peers.groupBy("lang", "block")).applyInPandas(run, _PAIRS)


def _scattered(audit: Audit, bucket_entries: int) -> DataFrame:
    """(lang, a, b, value): corrections for the terms that both have."""
    buckets = max(1, -(-audit.kept.count() // bucket_entries))
    rows = audit.entries().select("lang", F.expr(f"pmod(xxhash64(term), {buckets})").alias("bucket"), "term", "sid", "p", "p0", "peers")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lang, q0 = pdf["lang"].iloc[0], _vector(pdf)
        # the term-major index: the entries of term t are at[t]:at[t + 1]
        t = pd.factorize(pdf["term"])[0]
        order = np.argsort(t, kind="stable")
        sid, p, t = pdf["sid"].to_numpy()[order], pdf["p"].to_numpy()[order], t[order]
        at = np.searchsorted(t, np.arange(t[-1] + 2))
        by_group = np.argsort(sid, kind="stable")
        edges = np.flatnonzero(np.r_[True, np.diff(sid[by_group]) != 0, True])
        out = [_pairs(lang, np.empty(0), np.empty(0), np.empty(0, np.int64))]
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            mine = by_group[lo:hi]
            me = sid[mine[0]]
            sums = np.zeros(len(q0), np.int64)
            lengths = at[t[mine] + 1] - at[t[mine]]
            ends = np.cumsum(lengths)
            cut = 0
            while cut < len(mine):  # some index rows at a time
                to = max(cut + 1, int(np.searchsorted(ends, (ends[cut - 1] if cut else 0) + CELLS, "right")))
                n = lengths[cut:to]
                begin = np.repeat(at[t[mine[cut:to]]] - (np.cumsum(n) - n), n)
                posting = begin + np.arange(n.sum())
                peer, q, pa = sid[posting], p[posting], np.repeat(p[mine[cut:to]], n)
                z = q0[peer]
                np.add.at(sums, peer, _f(pa, q) - _f(pa, z) - _f(q0[me], q) + _f(q0[me], z))
                cut = to
            seen = np.flatnonzero(sums)
            seen = seen[seen != me]
            out.append(_pairs(lang, np.full(len(seen), me), seen, sums[seen]))
        return pd.concat(out)

    return rows.groupBy("lang", "bucket").applyInPandas(run, _PAIRS)


def pairs(audit: Audit, bucket_entries: int = ENTRIES) -> DataFrame:
    """lang, source, item (every other source of the language), value."""
    sums = (_baselines(audit).unionByName(_scattered(audit, bucket_entries))
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    names = audit.groups.select("lang", "sid", "source")
    mine = names.select("lang", F.col("sid").alias("a"), "source")
    other = names.select("lang", F.col("sid").alias("b"), F.col("source").alias("item"))
    return sums.join(mine, ["lang", "a"]).join(other, ["lang", "b"]).select(*GROUP, "item", "value")


def leading_terms(audit: Audit) -> DataFrame:
    """lang, source, item (a kept term more common here than in the language), value."""
    rows = audit.entries().withColumn("q", F.expr(_share("lang_count", "lang_n"))).where("p > q")
    return rows.select(*GROUP, F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div q").alias("value"))


def report(docs: DataFrame, min_docs: int = 3, top: int = 200) -> DataFrame:
    """lang, source, part, item, value, rank: all other sources and the ``top`` terms of each group."""
    audit = Audit(docs, min_docs)
    rank = F.row_number().over(Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item")).alias("rank")
    sources = pairs(audit).select(*GROUP, F.lit("pair").alias("part"), "item", "value", rank)
    found = leading_terms(audit).select(*GROUP, F.lit("term").alias("part"), "item", "value", rank).where(F.col("rank") <= top)
    return sources.unionByName(found)


ORACLE = """
with t as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
w as (select r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from t),
kept as (select lang, term, count(*) as c from w group by lang, term having count(distinct r) >= 3),
l as (select lang, sum(c)::hugeint as n, count(*)::hugeint as v from kept group by lang),
g as (select distinct lang, source from t),
c as (select lang, source, term, count(*) as c from w semi join kept using (lang, term) group by lang, source, term),
s as (select lang, source, sum(c)::hugeint as n from c group by lang, source),
dense as (select g.lang, g.source, k.term, coalesce(c.c, 0) as c, k.c as lc,
    1 + (1000000000::hugeint * (coalesce(c.c, 0) + 1)) // (coalesce(s.n, 0) + l.v) as p,
    1 + (1000000000::hugeint * (k.c + 1)) // (l.n + l.v) as q
  from g join kept k on k.lang = g.lang join l on l.lang = g.lang left join s on s.lang = g.lang and s.source = g.source
  left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
sums as (select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
  from dense a join dense b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by 1, 2, 3),
parts as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(x.value, 0)::bigint as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join sums x on x.lang = a.lang and x.source = a.source and x.item = b.source
  union all
  select lang, source, 'term', term, (((p - q) * (p - q)) // q)::bigint from dense where c > 0 and p > q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from parts)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 200
"""
