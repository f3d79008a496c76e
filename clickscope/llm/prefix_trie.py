"""Prefix trie of conversations by collapsing whole sequences.

Every conversation is rebuilt (``rebuilt``), and each of its turns gets the key of
the prefix that ends there: an exclusive-or of two 64-bit hashes of (position,
role, text), so that a prefix is a running aggregate and never a list.

1. *Collapse*: conversations with one key as a whole are one weighted sequence:
   its smallest conversation, their number, and the list of its ends.
2. *Leaves*: sequences that are a proper prefix of another are dropped by an
   anti-join; the rest are the leaves.
3. *Weighted prefixes*: the prefixes of the distinct sequences alone are
   grouped to nodes.  A sequence owns the nodes whose smallest member it has; those are
   its last ones, from some depth on (or none), so its ``start`` is all that is
   needed to add each node once to every node above it.

Turns of a conversation are ordered in slices of turn numbers (of positions,
for the running keys), so a very long conversation is not one sort.  Lists of ends
are joined in blocks of ``BLOCK`` consecutive ids; the blocks of a sequence are
hashed as a stream in order.  A digest needs its bytes in order, so that is one
task for a sequence, but it sees blocks, not conversations.

Cases: a null role or text is empty; null turns come first; turns of one
conversation with equal numbers are ordered by role and text, and repeated rows
are repeated turns; rows without conv_id belong to no conversation and are left out;
an empty table gives no node, not even a root; other columns are not read.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Turn numbers, or positions, of one slice.
SLICE = 256
#: Conversation ids of one block of a list of ends.
BLOCK = 4096
#: conv_id: the conversation whose head it gets, and the length of that head.
BASE = "conv_id - conv_id % 100"
HEAD = "crc32(cast(cast(conv_id as string) as binary)) % 6"
MOST = 5


def _ordered(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, a, b, points): the turns of each conversation from 1 on, their texts
    as two hashes and a length."""
    rows = turns.where("conv_id is not null").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.expr(f"floor(turn / {SLICE})").alias("slice"))
    w = Window.partitionBy("conv_id", "slice")
    rows = rows.select("conv_id", "slice", F.xxhash64("role", "text").alias("a"),
                       F.xxhash64(F.lit(1), "text", F.lit(2), "role").alias("b"), F.length("text").cast("long").alias("points"),
                       F.row_number().over(w.orderBy("turn", "role", "text")).alias("at"))
    rows = written(rows, "trie-turns")
    first = _before(rows.groupBy("conv_id", "slice").agg(F.count("*").alias("n")), F.sum("n"), F.lit(0))
    return (rows.withColumnRenamed("conv_id", "c").join(first, (F.col("c") == F.col("conv_id")) & rows["slice"].eqNullSafe(first["slice"]))
            .select("conv_id", (F.col("at") + F.col("before")).alias("pos"), "a", "b", "points"))


def _before(slices: DataFrame, total: Column, none: Column) -> DataFrame:
    """``slices`` of conversations with ``before``: ``total`` over the earlier slices."""
    w = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    return slices.withColumn("before", F.coalesce(total.over(w), none))


def rebuilt(turns: DataFrame, base: str = BASE, head: str = HEAD) -> DataFrame:
    """(conv_id, pos, a, b, points) of the rebuilt conversations, and a row with pos 0 for
    each.  ``base`` and ``head`` are SQL over conv_id; a head has at most ``MOST`` turns."""
    own = written(_ordered(turns), "trie-order")
    heads = own.where(f"pos <= {MOST}").select(F.col("conv_id").alias("base"), "pos", "a", "b", "points")
    found = heads.groupBy("base").agg(F.max("pos").alias("has"))
    convs = own.where("pos = 1").select("conv_id", F.expr(base).alias("base"), F.expr(head).cast("int").alias("head"))
    convs = convs.join(found, "base", "left").withColumn("got", F.least("head", F.coalesce("has", F.lit(0))))
    lead = convs.join(heads, "base").where("pos <= got").select("conv_id", "pos", "a", "b", "points")
    # what is left of a conversation follows the head that it got
    tail = own.join(convs.select("conv_id", "head", "got"), "conv_id").where("pos > head")
    tail = tail.select("conv_id", (F.col("pos") - F.col("head") + F.col("got")).alias("pos"), "a", "b", "points")
    root = convs.select("conv_id", F.lit(0).alias("pos"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"),
                        F.lit(0).cast("long").alias("points"))
    both = [c.select("conv_id", F.col("pos").cast("int").alias("pos"), "a", "b", "points") for c in (root, lead, tail)]
    return both[0].unionByName(both[1]).unionByName(both[2])


def _prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, x, y, points, sofar): the key of each prefix of each conversation, the
    length of its last turn and of all its turns."""
    keyed = turns.select("conv_id", "pos", F.when(F.col("pos") > 0, F.xxhash64("pos", "a", "b")).otherwise(0).alias("h"),
                         F.when(F.col("pos") > 0, F.xxhash64(F.lit(3), "b", "a", "pos")).otherwise(0).alias("g"), "points",
                         F.expr(f"pos div {SLICE}").alias("slice"))
    w = Window.partitionBy("conv_id", "slice").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = written(keyed.select("conv_id", "slice", F.col("pos").alias("depth"), F.bit_xor("h").over(w).alias("x"), F.bit_xor("g").over(w).alias("y"),
                                "points", F.sum("points").over(w).alias("sofar")), "trie-keys")
    ends = rows.groupBy("conv_id", "slice").agg(*[F.max_by(c, "depth").alias(c) for c in ("x", "y", "sofar")])
    w = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    ends = ends.select("conv_id", "slice", F.coalesce(F.bit_xor("x").over(w), zero).alias("x0"),
                       F.coalesce(F.bit_xor("y").over(w), zero).alias("y0"), F.coalesce(F.sum("sofar").over(w), zero).alias("s0"))
    # slices after the first are rare: all others need nothing from before
    later = rows.where("slice > 0").join(ends.where("slice > 0"), ["conv_id", "slice"]).select(
        "conv_id", "depth", F.col("x").bitwiseXOR(F.col("x0")).alias("x"), F.col("y").bitwiseXOR(F.col("y0")).alias("y"),
        "points", (F.col("sofar") + F.col("s0")).alias("sofar"))
    return rows.where("slice = 0").select(later.columns).unionByName(later)


def sequences(prefixes: DataFrame) -> DataFrame:
    """The collapse: (depth, x, y, conv_id, n, total), one row for each distinct whole
    sequence with its smallest conversation, their number and its length in code points."""
    return _wholes(prefixes).groupBy("depth", "x", "y").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), F.max("sofar").alias("total"))


def _wholes(prefixes: DataFrame) -> DataFrame:
    """(conv_id, depth, x, y, sofar): the last prefix of each conversation."""
    return prefixes.groupBy("conv_id").agg(F.max("depth").alias("depth"), *[F.max_by(c, "depth").alias(c) for c in ("x", "y", "sofar")])


def ends(prefixes: DataFrame) -> DataFrame:
    """(depth, x, y, ends_sha256): digest of the ids of the conversations that end there."""
    blocks = (_wholes(prefixes).groupBy("depth", "x", "y", F.expr(f"floor(conv_id / {BLOCK})").alias("block"))
              .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")))

    def run(batches):
        now, sha = None, None
        done = []
        for pdf in batches:
            for *key, ids in zip(pdf["depth"], pdf["x"], pdf["y"], pdf["ids"], strict=True):
                if key != now:
                    if now is not None:
                        done.append((*now, sha.hexdigest()))
                    now, sha = key, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if done:
                yield pd.DataFrame(done, columns=["depth", "x", "y", "ends_sha256"])
                done = []
        if now is not None:
            yield pd.DataFrame([(*now, sha.hexdigest())], columns=["depth", "x", "y", "ends_sha256"])

    return (blocks.repartition("depth", "x", "y").sortWithinPartitions("depth", "x", "y", "block").drop("block")
            .mapInPandas(run, "depth int, x long, y long, ends_sha256 string"))


def leaves(whole: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The sequences that are a proper prefix of no other."""
    proper = prefixes.where("not last").select("depth", "x", "y").distinct()
    return whole.join(proper, ["depth", "x", "y"], "left_anti")


def nodes(turns: DataFrame, base: str = BASE, head: str = HEAD) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    every = written(_prefixes(rebuilt(turns, base, head)), "trie-prefixes")
    whole = written(sequences(every), "trie-sequences")
    # the prefixes of the distinct sequences, each with its sequence's weight
    of = whole.select("conv_id", "n", "total", F.col("depth").alias("length"))
    way = every.join(of, "conv_id").withColumn("last", F.col("depth") == F.col("length"))
    way = written(way, "trie-weighted")
    leaf = leaves(whole, way).select("conv_id", F.lit(1).cast("long").alias("leaf"))
    # the first node that each sequence owns
    start = (way.groupBy("depth", "x", "y").agg(F.min("conv_id").alias("conv_id"))
             .groupBy("conv_id").agg(F.min("depth").alias("start")))
    above = start.join(every.select("conv_id", F.col("depth").alias("start"), (F.col("sofar") - F.col("points")).alias("over")),
                       ["conv_id", "start"])
    way = way.join(above.join(leaf, "conv_id", "full"), "conv_id", "left")
    # code points from the last turn of the prefix on; of the sequence's own nodes among them
    rest = F.col("total") - F.col("sofar") + F.col("points")
    way = way.withColumn("own", F.when(F.col("over").isNull(), 0).otherwise(F.least(rest, F.col("total") - F.col("over"))))
    found = way.groupBy("depth", "x", "y").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"), F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves"),
        # a sequence brings a child where its own nodes begin one deeper or go on
        F.count(F.when((F.col("depth") + 1 >= F.col("start")) & ~F.col("last"), 1)).alias("n_children"),
        F.sum(F.col("n") * rest - F.col("own")).alias("saved_tokens"))
    found = written(found, "trie-nodes")
    return _with_parents(found, every, start).join(ends(every), ["depth", "x", "y"], "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def _with_parents(found: DataFrame, every: DataFrame, start: DataFrame) -> DataFrame:
    """``found`` with parent_conv_id: a sequence's own nodes hang on each other, the first
    of them on the node with the key of its prefix one shorter."""
    tops = start.where("start > 0").join(every.select("conv_id", F.col("depth"), "x", "y"), "conv_id").where("depth = start - 1")
    owner = found.select("depth", "x", "y", F.col("conv_id").alias("parent_conv_id"))
    up = tops.join(owner, ["depth", "x", "y"]).select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("parent_conv_id").alias("up"))
    return found.join(up, ["conv_id", "depth"], "left").withColumn(
        "parent_conv_id", F.when(F.col("depth") > 0, F.coalesce("up", "conv_id")))


#: crc32 in SQL: the polynomial's table of 256 entries by rule, then one step a byte.
ORACLE = """
with tbl as (select list(c order by i) as t from (
  select i, list_reduce([i] || range(8), lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) as c
  from range(256) r(i))),
turns as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos
  from conversations where conv_id is not null),
own as (select conv_id, list({'r': role, 't': text} order by pos) as s from turns group by conv_id),
h as (select conv_id, s, (xor(list_reduce([4294967295::bigint] || list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 6)::int as h from own, tbl),
whole as (select a.conv_id, coalesce(b.s[1:a.h], []) || a.s[a.h + 1:] as s
  from h a left join own b on b.conv_id = a.conv_id - a.conv_id % 100),
pre as (select conv_id, s, d, s[1:d] as p from whole, unnest(range(len(s) + 1)) u(d)),
node as (select d, p, min(conv_id) as conv_id, count(*) as n_convs, case when d = 0 then 0 else length(p[d].t) end as points,
    string_agg(conv_id::varchar, ',' order by conv_id) filter (where len(s) = d) as ends
  from pre group by d, p),
kids as (select d - 1 as d, p[1:d - 1] as p, count(*) as n_children from node where d > 0 group by 1, 2),
up as (select n.*, coalesce(k.n_children, 0) as n_children from node n left join kids k on n.d = k.d and n.p = k.p),
sums as (select a.d, a.conv_id, sum((b.n_convs - 1) * b.points)::bigint as saved, count(*) filter (where b.n_children = 0) as n_leaves
  from up b, unnest(range(b.d + 1)) u(e) join up a on a.d = e and a.p = b.p[1:e] group by a.d, a.conv_id)
select u.conv_id, u.d::bigint as depth, case when u.d > 0 then o.conv_id end as parent_conv_id, u.n_convs, u.n_children, s.n_leaves,
  s.saved as saved_tokens, sha256(coalesce(u.ends, '')) as ends_sha256
from up u join sums s on s.d = u.d and s.conv_id = u.conv_id left join up o on o.d = u.d - 1 and o.p = u.p[1:u.d - 1]
"""
