"""Small helpers shared by the corpus operators.

Words are runs of bytes outside ``[\\x20\\x09-\\x0D]``: on UTF-8 bytes that is
exactly ``bytes.split()``, and ``bytes.lower()`` lower-cases A-Z only.
"""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickscope.session import fs_delete, run_dir

#: Rows of one Arrow batch: texts may have 100 kB and more, so batches are small.
ARROW_ROWS = 256
#: Column of the number of a row; ids may be null or repeat.
ROW = "__row"


def prepared(spark: SparkSession) -> SparkSession:
    """Keep Arrow batches of whole texts small in Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame, *keys: str) -> DataFrame:
    """(doc_id, keys, text as UTF-8 bytes); every other column is left behind."""
    return docs.select("doc_id", *keys, F.col("text").cast("binary").alias("text"))


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for a while."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def written(df: DataFrame, name: str, compression: str = "snappy", by: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder (in folders of column ``by``): cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = run_dir(spark, name)
    # level 1: the compressors' memory lies beside the heap, one for every column of every task
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):  # nothing reads its shuffles again
        (df.select("*").write.option("compression", compression).option("parquet.compression.codec.zstd.level", "1")
         .parquet(path, partitionBy=by))
    out = spark.read.schema(df.schema).parquet(path)
    out.table_path = path
    return out


def drop_tables(*tables: DataFrame, folder: str = "") -> None:
    """Delete ``written`` tables, or one folder of them, that no plan will read again."""
    for t in tables:
        fs_delete(t.sparkSession, f"{t.table_path}/{folder}")


def packed(docs: DataFrame):
    """All columns of ``docs`` as one column ``doc``, so that no name of theirs meets one of ours;
    ``select("doc.*")`` gives them back."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]).alias("doc")


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """(ROW, doc): the rows of ``docs`` with a number each, written so that it stays the same at every read."""
    return written(docs.select(F.monotonically_increasing_id().alias(ROW), packed(docs)), name)


def pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def unpack(b: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype=dtype)


def crc32_of_id(doc_id: str = "doc_id"):
    """crc32 of the decimal text of an id (null ids count as the empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def mix64(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))
