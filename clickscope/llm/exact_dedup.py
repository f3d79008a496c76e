"""Exact dedup as a stateful stream.

Two Structured Streaming queries over a folder (or file) of documents:

1. ``digests``: every new row's digest (SHA-256 of the text, A-Z lower-cased),
   its id and its content locator (file and row number) go to a log, exactly once.
2. ``state``: keyed state in RocksDB, one entry for each digest and no expiry,
   holds how many rows have come and, of the row that stays, the stable
   identifier and the content locator.  Rows of one digest are combined in each
   map task before they meet, so a text that a third of all rows repeat
   reaches its key as one row a task.

Both resume from their checkpoints: files that come later meet the state of all
earlier ones.  Micro-batches are bounded by ``batch_bytes``.

A digest that has come more than once is a *hit*.  ``decided`` reads the whole
texts of the hits back by their locators and compares them byte by byte:
rows of one digest with the bytes of the retained row are its copies, and rows with
other bytes (a collision) form classes of their own.  Equal texts
collapse in the map tasks, so no copy is compared alone.

Cases: a null text counts as empty; a null id is smaller than any other; of
equal texts with equal ids one row stays, the one with the last locator; an empty
table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickscope.session import fs_exists

from .common import prepared, setting, written

#: Bytes of input in one micro-batch.
BATCH_BYTES = 64 << 30
_LOG = "doc_id long, digest binary, file string, row long"


def sha256(text: bytes) -> bytes:
    return hashlib.sha256(text).digest()


def _normal(text):
    return (text or b"").lower()  # bytes: A-Z only


def _digest(digest):
    @F.pandas_udf(T.BinaryType())
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([digest(_normal(t)) for t in texts.tolist()], dtype=object)
    return of


@F.pandas_udf(T.BinaryType())
def normal(texts: pd.Series) -> pd.Series:
    return pd.Series([_normal(t) for t in texts.tolist()], dtype=object)


def _any(path: str) -> str:
    """``path`` as a pattern, which a file stream takes for files and folders alike."""
    head, _, last = path.rstrip("/").rpartition("/")
    return f"{head}/{{{last}}}" if head else f"{{{last}}}"


def _located(docs: DataFrame) -> list:
    at = docs.metadataColumn("_metadata")
    return [at["file_path"].alias("file"), at["row_index"].alias("row")]


@contextmanager
def _stores(spark: SparkSession):
    """State in RocksDB, which takes no room ahead: it would be some MB of disk for every partition, however small."""
    key = "spark.sql.streaming.stateStore"
    with setting(spark, f"{key}.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"), \
            setting(spark, f"{key}.rocksdb.allowFAllocate", "false"):
        yield


def ingest(spark: SparkSession, path: str, root: str, digest=sha256, batch_bytes: int = BATCH_BYTES,
           batch_files: int | None = None) -> None:
    """Take in what is new under ``path``, in micro-batches of so many bytes, or files where given;
    log, state and checkpoints lie under ``root``."""
    prepared(spark)
    schema = spark.read.parquet(path).select("doc_id", "text").schema
    bound = ("maxFilesPerTrigger", batch_files) if batch_files else ("maxBytesPerTrigger", batch_bytes)
    docs = spark.readStream.schema(schema).option(*bound).parquet(_any(path))
    rows = docs.select("doc_id", _digest(digest)(F.col("text").cast("binary")).alias("digest"), *_located(docs))
    (rows.writeStream.format("parquet").option("path", f"{root}/digests").option("checkpointLocation", f"{root}/_digests")
     .trigger(availableNow=True).start().awaitTermination())
    log = spark.readStream.schema(_LOG).parquet(f"{root}/digests")
    kept = log.groupBy("digest").agg(F.count("*").alias("n"), F.max(F.struct("doc_id", "file", "row")).alias("top"))
    with _stores(spark):
        (kept.writeStream.outputMode("update").format("noop").option("checkpointLocation", f"{root}/_state")
         .trigger(availableNow=True).start().awaitTermination())


def state(spark: SparkSession, root: str) -> DataFrame:
    """(digest, n, top): the keyed state; ``top`` is (doc_id, file, row) of the row that stays."""
    if not fs_exists(spark, f"{root}/_state/state"):
        return spark.createDataFrame([], "digest binary, n long, top struct<doc_id: long, file: string, row: long>")
    return spark.read.format("statestore").load(f"{root}/_state").select(
        "key.digest", F.col("value.count").alias("n"), F.col("value.max").alias("top"))


def decided(spark: SparkSession, path: str, root: str) -> DataFrame:
    """doc_id, digest, keep_id, group_size, kept: one row for each document taken in."""
    prepared(spark)
    log = spark.read.schema(_LOG).parquet(f"{root}/digests") if fs_exists(spark, f"{root}/digests") else spark.createDataFrame([], _LOG)
    with _stores(spark):
        known = written(state(spark, root), "exact-state")
    hits = log.join(known.where("n > 1").select("digest"), "digest", "left_semi")
    # bytes whose last row is not the retained one differ from the retained row's
    other = _classes(_fetched(spark, path, hits)).select("digest", F.col("top").alias("own"))
    wrong = written(other.join(known, "digest").where("own != top").select("digest").distinct(), "exact-collisions")
    out = log.join(known, "digest")
    if not wrong.isEmpty():
        own = _fetched(spark, path, log.join(wrong, "digest", "left_semi"))
        out = out.join(wrong, "digest", "left_anti").unionByName(own.join(_classes(own), ["digest", "normal"]).drop("normal"))
    return out.select("doc_id", "digest", F.col("top.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
                      ((F.col("file") == F.col("top.file")) & (F.col("row") == F.col("top.row"))).alias("kept"))


def _fetched(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """``rows`` of the log with their whole normalised texts, read by locator."""
    docs = spark.read.parquet(path)
    content = docs.select(F.col("text").cast("binary").alias("text"), *_located(docs))
    return content.join(rows, ["file", "row"]).withColumn("normal", normal("text")).drop("text")


def _classes(rows: DataFrame) -> DataFrame:
    """(digest, normal, n, top) of each digest and its different bytes."""
    return rows.groupBy("digest", "normal").agg(F.count("*").alias("n"), F.max(F.struct("doc_id", "file", "row")).alias("top"))


def dedup(spark: SparkSession, path: str, root: str) -> DataFrame:
    """Take in ``path`` and decide: doc_id, keep_id, group_size, kept, text_sha256."""
    ingest(spark, path, root)
    return decided(spark, path, root).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE = """
with t as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as x from documents)
select doc_id, max(doc_id) over (partition by x) as keep_id, count(*) over (partition by x) as group_size,
  row_number() over (partition by x order by doc_id desc nulls last) = 1 as kept, sha256(x) as text_sha256
from t
"""
