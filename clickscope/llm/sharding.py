"""Sharding by extendible hashing.

A document's hash is the first 60 bits of the MD5 of its id.  The directory is
indexed by a hash prefix; a bucket over the byte limit, and no other, is split
on one more bit until it fits.  Only (prefix, bytes, rows) is gathered: sums per
prefix of ``step`` bits, combined before the shuffle, are rolled up to every
shorter prefix, and the first prefix on a document's way that fits is its
shard.  Prefixes that are still too large go on with the next ``step`` bits.

Rows that share all 60 bits (repeated ids) cannot be split by bits: past the last
bit they are dealt to overflow shards by a running byte count, each at most
the limit.  A row larger than the limit is a shard by itself (``oversized``).

Cases: null ids hash as the empty text and a null text has no bytes; repeated
rows are each placed; an empty table gives an empty table; the columns
of ``docs`` other than doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

BITS = 60
STEP = 15
#: Bytes of a shard in the registered query.
LIMIT = 262_144
#: Slices in which rows of one size in one full bucket are numbered.
SLICES = 64


def hashed(docs: DataFrame) -> DataFrame:
    """(doc_id, bytes, h): h holds the 60 hash bits as a long."""
    return docs.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"),
        F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10)
        .cast("long").alias("h"))


def _prefix(h: str, depth) -> F.Column:
    return F.expr(f"shiftright({h}, {BITS} - {depth})")


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """(depth, prefix, bytes, n_rows) of every shard; a bucket at depth 60 may still
    be over the limit.  ``rows``: (h, bytes)."""
    done = None
    left = rows.select("h", "bytes")
    top = 0
    while True:
        to = min(top + STEP, BITS)
        # sums at the finest prefix of this step, then rolled up to each shorter one
        fine = written(left.groupBy(_prefix("h", to).alias("p"))
                       .agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n_rows")), "shard-sums")
        rolled = (fine.select(F.explode(F.sequence(F.lit(top), F.lit(to))).alias("depth"), "p", "bytes", "n_rows")
                  .groupBy("depth", F.expr(f"shiftright(p, {to} - depth)").alias("prefix"))
                  .agg(F.sum("bytes").alias("bytes"), F.sum("n_rows").alias("n_rows")))
        rolled = written(rolled.withColumn("fits", F.expr(f"bytes <= {limit} or n_rows = 1 or depth = {BITS}")), "shard-levels")
        over = rolled.where("not fits").select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("up"))
        # a shard fits, and the bucket that it was split from did not
        split = rolled.where((F.col("depth") > top) & F.col("fits")).withColumn("up", F.expr("shiftright(prefix, 1)"))
        found = split.join(over, ["depth", "up"], "left_semi").drop("up", "fits")
        if top == 0:
            found = found.unionByName(rolled.where("depth = 0 and fits").drop("fits"))
        done = found if done is None else done.unionByName(found)
        more = rolled.where(f"depth = {to} and not fits").select(F.col("prefix").alias("__p"))
        if to == BITS or more.isEmpty():
            return written(done, "shard-directory")
        left = left.join(more, _prefix("h", to) == F.col("__p"), "left_semi")
        top = to


def shards(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, bytes, shard_id (the prefix bits as text, then ``+k`` in overflow
    shards), depth, shard_bytes, oversized: one row for each document."""
    rows = written(hashed(docs), "shard-rows")
    found = directory(rows, limit)
    placed = _placed(rows, found, limit)
    plain = placed.where("not hot")
    if found.where(_hot("bytes", limit)).isEmpty():
        out = plain
    else:
        out = plain.unionByName(_overflow(placed.where("hot"), limit))
    return out.select("doc_id", "bytes", "shard_id", "depth", "shard_bytes",
                      (F.col("shard_bytes") > limit).alias("oversized"))


def _hot(size: str, limit: int) -> str:
    """Condition on a shard: no bit is left, and it is still too large."""
    return f"depth = {BITS} and {size} > {limit} and n_rows > 1"


def _placed(rows: DataFrame, found: DataFrame, limit: int) -> DataFrame:
    """``rows`` with their shard by bits alone; ``hot``: it has to overflow."""
    # each depth that is in use is one equi-join key: (depth, prefix)
    depths = [r[0] for r in found.select("depth").distinct().collect()]  # 61 at most
    ways = F.array(*[F.struct(F.lit(d).alias("depth"), _prefix("h", d).alias("prefix")) for d in sorted(depths)])
    way = rows.select("doc_id", "bytes", "h", F.explode(ways).alias("w")).select("doc_id", "bytes", "h", "w.*") if depths else \
        rows.select("doc_id", "bytes", "h", F.lit(0).alias("depth"), F.lit(0).cast("long").alias("prefix"))
    placed = way.join(found.withColumnRenamed("bytes", "shard_bytes"), ["depth", "prefix"])
    bits = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.expr(f"lpad(conv(prefix, 10, 2), depth, '0')"))
    return placed.select("*", bits.alias("shard_id"), F.expr(_hot("shard_bytes", limit)).alias("hot"))


def _overflow(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of buckets that have no bit left, in order of their bytes, dealt to shards of half-limit
    slots by a running byte count; a row over half the limit is a shard by itself.

    The count is taken over (bytes, slice): rows of equal size take consecutive places, and
    slices of them are numbered apart, so no bucket and no size is one task.  Which of
    several rows of one size is where does not change a shard's size or name, so these do not depend on
    how the rows are partitioned."""
    rows = written(rows.withColumn("slice", F.pmod(F.monotonically_increasing_id(), F.lit(SLICES))), "shard-overflow")
    key = ["shard_id", "bytes", "slice"]
    ahead = Window.partitionBy("shard_id").orderBy("bytes", "slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(*key).agg(F.count("*").alias("n")).select(
        *key, F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum(F.col("n") * F.col("bytes")).over(ahead), F.lit(0)).alias("bytes_before"))
    k = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0))) - 1
    own = rows.withColumn("k", k).join(sizes, key)
    # rows that begin in the same half-limit slot weigh at most the limit together
    start = F.col("bytes_before") + F.col("k") * F.col("bytes")
    slot = (F.when(2 * F.col("bytes") > limit, F.concat(F.lit("+b"), F.col("rows_before") + F.col("k")))
            .otherwise(F.concat(F.lit("+s"), F.floor(start / F.lit(max(1, limit // 2))))))
    both = own.withColumn("shard_id", F.concat("shard_id", slot)).drop("k", "rows_before", "bytes_before")
    sums = written(both.groupBy("shard_id").agg(F.sum("bytes").alias("shard_bytes")), "shard-overflow-sums")
    return both.drop("slice", "shard_bytes").join(sums, "shard_id").select(*[c for c in rows.columns if c != "slice"])


ORACLE = f"""
with recursive h as (
  select doc_id, coalesce(octet_length(encode(text)), 0)::bigint as bytes,
         ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint as h
  from documents),
b(depth, prefix, bytes, n) as (
  select 0, 0::bigint, sum(bytes)::bigint, count(*) from h
  union all
  select s.depth + 1, s.child, (select sum(bytes)::bigint from h where h >> (59 - s.depth) = s.child),
         (select count(*) from h where h >> (59 - s.depth) = s.child)
  from (select depth, 2 * prefix + bit as child from b, (values (0), (1)) v(bit)
        where bytes > {LIMIT} and n > 1 and depth < 60) s),
d as (select depth, prefix, bytes as shard_bytes from b where n > 0 and (bytes <= {LIMIT} or n = 1))
select doc_id, h.bytes, case when depth = 0 then '' else right(repeat('0', 60) || bin(prefix), depth) end as shard_id,
       depth, shard_bytes, shard_bytes > {LIMIT} as oversized
from h join d on h.h >> (60 - depth) = prefix
"""


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT) -> None:
    """Whole documents (every column), each once, under ``path``/__shard=<id>; each shard
    is written by one task."""
    rows = written(hashed(docs), "shard-rows")
    # rows of one id have one hash, so the id alone finds their shard by bits
    of = _placed(rows, directory(rows, limit), limit).select("doc_id", "shard_id", "shard_bytes", "hot").distinct()
    whole = docs.select(F.struct(*docs.columns).alias("doc"), F.col("doc_id").alias("id"),
                        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"))
    whole = whole.join(of, whole["id"].eqNullSafe(of["doc_id"])).select("doc", "bytes", "shard_id", "shard_bytes", "hot")
    both = whole.where("not hot").unionByName(_overflow(whole.where("hot"), limit))
    (both.select("doc.*", F.col("shard_id").alias("__shard"))
     .repartition("__shard").write.partitionBy("__shard").parquet(path))
