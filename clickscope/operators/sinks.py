"""Result sinks (SNK1-SNK7).

The upsert semantics of the original JDBC DAOs are first pure functions
``(old, batch) -> new`` over DataFrames (oracle-testable), then bound to
storage: JDBC append, Parquet tables, and replay-safe per-batch folders for
streams."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscope.session import fs_delete, fs_publish, fs_status

# --- pure merge semantics ---------------------------------------------------


def upsert_add(old: DataFrame, batch: DataFrame, keys: Sequence[str], value: str = "click_count") -> DataFrame:
    """SNK2: add the batch's counts to the stored ones, insert new keys.
    One union + one aggregate (map-side combined)."""
    cols = list(keys) + [value]
    return (old.select(*cols).unionByName(batch.select(*cols))
            .groupBy(*keys).agg(F.sum(value).cast("bigint").alias(value)))


def upsert_replace(old: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SNK3: a batch row overwrites the stored row of its key; other keys stay."""
    cols = batch.columns
    kept = old.select(*cols).join(batch.select(*keys), list(keys), "left_anti")
    return kept.unionByName(batch.select(*cols))


def replace_group(old: DataFrame, batch: DataFrame, group: Sequence[str]) -> DataFrame:
    """SNK4: every group present in the batch replaces all stored rows of that
    group (delete-then-insert per group)."""
    cols = batch.columns
    groups = batch.select(*group).distinct()
    kept = old.select(*cols).join(groups, list(group), "left_anti")
    return kept.unionByName(batch.select(*cols))


def insert_new(old: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SNK5: insert-only set; returns the rows to append (absent keys, once)."""
    return batch.select(*keys).dropDuplicates(list(keys)).join(old.select(*keys), list(keys), "left_anti")


def lookup_counts(keys_df: DataFrame, counts: DataFrame, keys: Sequence[str], value: str = "click_count") -> DataFrame:
    """SNK6: the stored count for each key of ``keys_df`` (0 when absent) -
    one left join instead of one query per key."""
    return (keys_df.select(*keys).join(counts.select(*keys, value), list(keys), "left")
            .withColumn(value, F.coalesce(F.col(value), F.lit(0)).cast("bigint")))


# --- storage bindings ---------------------------------------------------------


def jdbc_append(df: DataFrame, url: str, table: str, properties: dict | None = None) -> None:
    """SNK1: append a result table through Spark's JDBC writer (one connection
    per partition, batched inserts)."""
    df.write.jdbc(url=url, table=table, mode="append", properties=properties or {})


def save_table(df: DataFrame, path_or_table: str, as_table: bool = False) -> None:
    """SNK7: drop-and-save (overwrite) a table or a Parquet folder."""
    w = df.write.mode("overwrite")
    if as_table:
        w.saveAsTable(path_or_table)
    else:
        w.parquet(path_or_table)


def show(df: DataFrame, n: int = 20) -> None:
    """SNK8: print a bounded preview."""
    df.show(n, truncate=False)


def _fs(spark, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def publish_batch(df: DataFrame, root: str, batch_id: int, partition_by: Sequence[str] = ()) -> bool:
    """Write one micro-batch's rows to ``root/batch_id=N`` exactly once, in folders of the
    ``partition_by`` columns when given.

    The rows are written to a staging folder, then renamed into place; a
    replayed batch whose folder already exists is skipped.  Readers of
    ``root`` (batch or a streaming file source) therefore see every batch
    once.  Rename is atomic on local disks and HDFS; on object stores use a
    transactional table format instead."""
    spark = df.sparkSession
    target = f"{root.rstrip('/')}/batch_id={batch_id}"
    if _exists(spark, target):
        return False
    staging = f"{root.rstrip('/')}/_staging/batch_id={batch_id}-{uuid.uuid4().hex[:8]}"
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(staging)
    # False when a concurrent attempt of the same batch published first
    return fs_publish(spark, staging, target)


def read_batches(spark, root: str, schema=None) -> DataFrame:
    """All published batches of ``root`` (``batch_id`` as a column)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.option("basePath", root).parquet(f"{root.rstrip('/')}/batch_id=*")


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: str = "batch_id") -> DataFrame:
    """The row of the newest batch for each key (upsert-replace over published
    batches).  One ``max_by`` per column, so fixed-width values stay in a hash
    aggregate (a struct would make it sort-based)."""
    vals = [c for c in rows.columns if c not in set(keys) | {order}]
    return rows.groupBy(*keys).agg(*[F.max_by(c, order).alias(c) for c in vals])


__all__ = ["VersionedTable", "upsert_add", "upsert_replace", "replace_group", "insert_new", "lookup_counts", "jdbc_append",
           "save_table", "show", "publish_batch", "read_batches", "latest_per_key"]


class VersionedTable:
    """A Parquet table updated by read-merge-write without overwriting the
    folder being read: each update writes ``root/v=N+1`` (staging + rename)
    from version N merged with the batch; readers take the newest complete
    version.  Binds the merge semantics above (SNK2-SNK4) to storage outside
    a stream.  A version is deleted when ``keep`` newer ones exist and the one that
    replaced it is ``keep_ms`` old: readers may still be at it until then."""

    def __init__(self, spark, root: str, schema=None, keep: int = 3, keep_ms: int = 24 * 3600 * 1000):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.keep = keep
        self.keep_ms = keep_ms

    def _versions(self) -> list[int]:
        p, fs = _fs(self.spark, f"{self.root}/v=*")
        out = []
        for st in fs.globStatus(p) or []:
            name = st.getPath().getName()
            try:
                v = int(name.split("=", 1)[1])
            except ValueError:
                continue
            if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}/_SUCCESS")):
                out.append(v)
        return sorted(out)

    def version(self) -> int | None:
        v = self._versions()
        return v[-1] if v else None

    def read(self, version: int | None = None) -> DataFrame | None:
        v = self.version() if version is None else version
        if v is None:
            return None
        r = self.spark.read
        if self.schema is not None:
            r = r.schema(self.schema)
        return r.parquet(f"{self.root}/v={v}")

    def update(self, batch: DataFrame, merge) -> int:
        """Write ``merge(current, batch)`` (or the batch alone for a new
        table) as the next version; returns the new version number."""
        base = self.version()  # read once: a version published meanwhile makes this update fail, not vanish
        current = self.read(base)
        new = batch if current is None else merge(current, batch)
        v = (base or 0) + 1
        staging = f"{self.root}/_staging/v={v}-{uuid.uuid4().hex[:8]}"
        new.write.mode("overwrite").parquet(staging)
        if not fs_publish(self.spark, staging, f"{self.root}/v={v}"):
            raise RuntimeError(f"concurrent update of {self.root} (version {v} exists)")
        at = {int(path.rsplit("=", 1)[1]): t for path, t in fs_status(self.spark, f"{self.root}/v=*")}
        for old in self._versions()[:-self.keep]:
            if at[v] - at.get(old + 1, at[v]) >= self.keep_ms:
                fs_delete(self.spark, f"{self.root}/v={old}")
        return v
