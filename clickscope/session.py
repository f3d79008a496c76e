"""Spark session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings every job relies on: UTC so event-time strings agree with
# other engines, AQE for runtime re-planning (partition coalescing, skew
# splitting, broadcast conversion of joins whose measured side is small).
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # lists of values are gathered in a hash table up to so many groups of a task
    # (the default of 128 makes nearly every such aggregate sort)
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "clickscope", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_session_conf(spark)
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    """Pin the SQL settings the operators depend on (idempotent)."""
    for k, v in SESSION_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception as e:
            now = spark.conf.get(k, None)
            if now != v:  # a locked setting may stay only if it says the same
                raise RuntimeError(f"{k} must be {v}, the session holds it at {now}") from e


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Taken from ``spark.checkpoint.dir`` as the cluster names it; only when it
    is unset on a local master (tests) a fresh folder is created and registered.
    Elsewhere a folder of one machine would lose rows, so that is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named and not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    # the cluster's folder when it names one (registered so checkpoint() works);
    # a fresh local folder only when nothing is set, as in tests
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="clickscope-ckpt-"))
    return sc.getCheckpointDir()


def run_dir(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared working folder."""
    base = work_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def _path(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def fs_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return bool(fs.exists(p))


def fs_status(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """(path, modification time in ms) of what matches a glob pattern; names only, no data."""
    p, fs = _path(spark, pattern)
    return [(st.getPath().toString(), int(st.getModificationTime())) for st in fs.globStatus(p) or []]


def fs_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, bytes, modification time) of a file, or of the data files right in a folder."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return []
    own = fs.getFileStatus(p)
    found = fs.listStatus(p) if own.isDirectory() else [own]
    out = [(st.getPath().toString(), int(st.getLen()), int(st.getModificationTime())) for st in found
           if not st.getPath().getName().startswith(("_", "."))]
    return sorted(out)


def fs_delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def fs_mkdirs(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.mkdirs(p)


def fs_write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file; an existing one is replaced."""
    p, fs = _path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def fs_read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None where there is none."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return None
    source = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def fs_publish(spark: SparkSession, staging: str, target: str) -> bool:
    """Move a fully written ``staging`` folder to ``target`` atomically.

    Uses a rename that refuses an existing target (a plain file-system
    rename would move the folder *into* it).  Returns False - and drops the
    staging copy - when the target already exists, e.g. when another attempt
    of the same batch published first."""
    jvm = spark._jvm
    src, fs = _path(spark, staging)
    dst, _ = _path(spark, target)
    fs.mkdirs(dst.getParent())
    fc = jvm.org.apache.hadoop.fs.FileContext.getFileContext(dst.toUri(), spark._jsc.hadoopConfiguration())
    opts = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    opts[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        fc.rename(src, dst, opts)
        return True
    except Exception:
        if fs.exists(dst):
            fs.delete(src, True)
            return False
        raise
