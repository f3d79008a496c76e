"""Replay-safe tables of a stream: one folder per micro-batch, compacted by partition.

    root/batch_id=N/<p1>=../[<p2>=..]          rows of micro-batch N
    root/_compact/upto=C/<p1>=../[<p2>=..]     partitions merged over batches < C

A micro-batch is published by one rename and skipped when its folder exists.  A
compaction, also published by one rename, writes only those partitions
(values of the first partition column, e.g. event days) that batches since the
last one brought rows for: a closed day is never read or written again.  A
reader takes each partition from its newest compaction and adds the batches
after the last one, so it costs what the asked partitions hold and
fewer than ``compact_every`` small folders.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickscope.operators.sinks import latest_per_key, publish_batch
from clickscope.session import fs_delete, fs_exists, fs_publish, fs_status

#: Replaced folders stay this long for readers that have listed them.
KEEP_MS = 24 * 3600 * 1000


class BatchLog:
    """``mode`` says how rows of one key in several batches merge:

    * ``"latest"`` - the row of the newest batch (upsert-replace);
    * ``"sum"``    - the sum of the one value column (upsert-add);
    * ``"group"``  - all rows of the newest batch that wrote the key (replace-group);
    * ``"first"``  - keys alone, each once (insert-only).

    ``schema`` holds all columns of the table, the partition columns included;
    ``partition_by`` may be empty (then a compaction rewrites the whole, small table)."""

    MODES = ("latest", "sum", "group", "first")

    def __init__(self, spark, root: str, keys: Sequence[str], mode: str, schema: T.StructType,
                 partition_by: Sequence[str] = (), compact_every: int = 100):
        assert mode in self.MODES
        self.spark = spark
        self.root = root.rstrip("/")
        self.keys = list(keys)
        self.mode = mode
        self.schema = schema
        self.partition_by = list(partition_by)
        self.compact_every = compact_every

    # --- folders ----------------------------------------------------------------

    def _ids(self, pattern: str) -> list[int]:
        """Numbers of the published ``pattern=N`` folders."""
        names = (path.rsplit("=", 1)[1] for path, _ in fs_status(self.spark, f"{self.root}/{pattern}=*"))
        return sorted(int(n) for n in names if n.isdigit())

    def any(self) -> bool:
        return bool(self._ids("batch_id"))

    def _base(self, before: int | None) -> int | None:
        """The newest compaction that a reader of the batches ``< before`` may use."""
        return max((c for c in self._ids("_compact/upto") if before is None or c <= before), default=None)

    def _tail(self, base: int | None, before: int | None) -> list[int]:
        return [b for b in self._ids("batch_id") if b >= (base or 0) and (before is None or b < before)]

    def _compacted(self, base: int | None, values: Iterable[str] | None = None) -> dict[str, tuple[int, str, int]]:
        """Partition -> (compaction, folder, age stamp) of its newest compaction ``<= base``."""
        if base is None:
            return {}
        if not self.partition_by:
            return {"": (base, f"{self.root}/_compact/upto={base}", 0)}
        p1 = self.partition_by[0]
        some = [f"{p1}={v}" for v in values] if values is not None else [f"{p1}=*"]
        found: dict[str, tuple[int, str, int]] = {}
        for name in some:
            for path, at in fs_status(self.spark, f"{self.root}/_compact/upto=*/{name}"):
                run, part = path.rsplit("/", 2)[1:]
                run = int(run.split("=", 1)[1])
                if run <= base and run > found.get(part, (-1,))[0]:
                    found[part] = (run, path, at)
        return found

    # --- reading ----------------------------------------------------------------

    def _read(self, paths: list[str], base: str, extra: str) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(extra, T.LongType())])
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths)

    def _parts(self, before: int | None, values=None, condition=None) -> DataFrame | None:
        """Rows of the asked partitions with ``batch_id``, not merged yet."""
        base = self._base(before)
        parts = []
        tail = self._tail(base, before)
        paths = [f"{self.root}/batch_id={b}" for b in tail]
        if values is not None:
            p1 = self.partition_by[0]
            paths = [path for v in values for path, _ in fs_status(self.spark, f"{self.root}/batch_id=*/{p1}={v}")
                     if int(path.rsplit("/", 2)[1].split("=", 1)[1]) in set(tail)]
        if paths:
            parts.append(self._read(paths, self.root, "batch_id"))
        found = self._compacted(base, values)
        if found:
            old = self._read([path for _, path, _ in found.values()], f"{self.root}/_compact", "upto")
            parts.append(old.withColumn("upto", F.lit(-1).cast("long")).withColumnRenamed("upto", "batch_id"))
        if not parts:
            return None
        out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return out if condition is None else out.where(condition)

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def last(self, before: int) -> DataFrame:
        """The rows of the newest batch ``< before`` alone."""
        ids = [b for b in self._ids("batch_id") if b < before]
        return self.batch(ids[-1]) if ids else self._empty()

    def days(self) -> list[str]:
        """Values of the first partition column, from folder names."""
        p1 = self.partition_by[0]
        paths = [*fs_status(self.spark, f"{self.root}/batch_id=*/{p1}=*"), *fs_status(self.spark, f"{self.root}/_compact/upto=*/{p1}=*")]
        return sorted({path.rsplit("=", 1)[1] for path, _ in paths})

    def batch(self, batch_id: int) -> DataFrame:
        """The rows of one published batch."""
        return self._read([f"{self.root}/batch_id={batch_id}"], self.root, "batch_id").drop("batch_id")

    def merged(self, rows: DataFrame) -> DataFrame:
        names = self.schema.fieldNames()
        if self.mode == "latest":
            out = latest_per_key(rows, self.keys)
        elif self.mode == "sum":
            value = [c for c in names if c not in self.keys]
            out = rows.groupBy(*self.keys).agg(*[F.sum(c).cast("bigint").alias(c) for c in value])
        elif self.mode == "first":
            out = rows.select(*names).distinct()
        else:
            newest = rows.groupBy(*self.keys).agg(F.max("batch_id").alias("batch_id"))
            out = rows.join(newest, [*self.keys, "batch_id"], "left_semi")
        return out.select(*names)

    def view(self, before: int | None = None, values: Iterable[str] | None = None, condition=None) -> DataFrame:
        """The table over the batches ``< before`` (all when None); only partitions whose
        first column is one of ``values``, and rows for which ``condition`` (best on a
        partition column) holds, are read."""
        rows = self._parts(before, values, condition)
        return self._empty() if rows is None else self.merged(rows)

    def lookup(self, keys: DataFrame, before: int | None = None, values=None, condition=None) -> DataFrame:
        """``view`` of the rows whose key columns occur in ``keys``: they are looked up before
        the merge, so only they are shuffled."""
        rows = self._parts(before, values, condition)
        if rows is None:
            return self._empty()
        wanted = keys.select(*[c for c in self.keys if c in keys.columns]).distinct()
        return self.merged(rows.join(wanted, wanted.columns, "left_semi"))

    # --- writing ----------------------------------------------------------------

    def publish(self, df: DataFrame, batch_id: int) -> bool:
        """Publish one batch; first compact the history before it when
        ``compact_every`` folders or more have come since the last compaction."""
        if self.compact_every and len(self._tail(self._base(batch_id), batch_id)) >= self.compact_every:
            self.compact(batch_id)
        return publish_batch(self._dealt(df.select(*self.schema.fieldNames())), self.root, batch_id, self.partition_by)

    def _dealt(self, df: DataFrame) -> DataFrame:
        """Rows of one folder come from one task: a folder gets one file, not one of every task."""
        return df.repartition(*self.partition_by) if self.partition_by else df.coalesce(1)

    def compact(self, upto: int) -> bool:
        """Merge what came since the last compaction into the partitions that it touches."""
        target = f"{self.root}/_compact/upto={upto}"
        if fs_exists(self.spark, target):
            return False
        base = self._base(upto)
        tail = self._tail(base, upto)
        if not tail:
            return False
        values = self._touched(tail)
        rows = self._parts(upto, values)
        staging = f"{self.root}/_staging/compact-{upto}-{uuid.uuid4().hex[:8]}"
        w = self._dealt(self._empty() if rows is None else self.merged(rows)).write  # no rows: only the mark of the run
        (w.partitionBy(*self.partition_by) if self.partition_by else w).mode("overwrite").parquet(staging)
        done = fs_publish(self.spark, staging, target)
        if done:
            self._drop_replaced(upto)
        return done

    def _touched(self, tail: Sequence[int]) -> list[str] | None:
        """Values of the first partition column in the given batches, from folder names."""
        if not self.partition_by:
            return None
        p1 = self.partition_by[0]
        return sorted({path.rsplit("=", 1)[1] for b in tail
                       for path, _ in fs_status(self.spark, f"{self.root}/batch_id={b}/{p1}=*")})

    def _drop_replaced(self, upto: int) -> None:
        """Delete batches and partitions that a compaction replaced, once it is ``KEEP_MS`` old."""
        stamps = {c: at for path, at in fs_status(self.spark, f"{self.root}/_compact/upto=*")
                  for c in [int(path.rsplit("=", 1)[1])]}
        old = max((c for c, at in stamps.items() if max(stamps.values()) - at > KEEP_MS), default=None)
        if old is None:
            return
        for b in self._ids("batch_id"):
            if b < old:
                fs_delete(self.spark, f"{self.root}/batch_id={b}")
        if not self.partition_by:
            return
        newest = self._compacted(old)
        for path, _ in fs_status(self.spark, f"{self.root}/_compact/upto=*/{self.partition_by[0]}=*"):
            run, part = path.rsplit("/", 2)[1:]
            if int(run.split("=", 1)[1]) < newest.get(part, (0,))[0]:
                fs_delete(self.spark, path)

    def drop_batches(self, before: int) -> None:
        """Delete the batches ``< before`` of a log whose last batch alone is read."""
        for b in self._ids("batch_id"):
            if b < before:
                fs_delete(self.spark, f"{self.root}/batch_id={b}")

    def forget(self, before_value: str) -> None:
        """Delete the compacted partitions whose first column is less than ``before_value``."""
        p1 = self.partition_by[0]
        for path, _ in fs_status(self.spark, f"{self.root}/_compact/upto=*/{p1}=*"):
            if path.rsplit("=", 1)[1] < before_value:
                fs_delete(self.spark, path)
