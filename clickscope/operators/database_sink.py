"""Stream outputs in database tables, replay-safe (ST7 over SNK2-SNK5).

A micro-batch's rows are first written to a staging table of their own by Spark's
JDBC writer, in parallel.  Then one transaction looks the batch up in a ledger of
(table, batch id); if it is not there, it merges the staging table into the target
and enters the batch.  A batch that is replayed after a failure, before or after
the commit, therefore counts once, and no reader sees half of it.

The ledger's primary key lets one of two concurrent attempts of a batch fail.
"""

from __future__ import annotations

import uuid
from abc import ABC, abstractmethod
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

#: Table of the batches that are in.
LEDGER = "stream_batches"
#: Result tables of the ad stream: key columns and values.
RESULT_TABLES = {
    "ad_user_click_count": (("date", "userid", "adid"), ("click_count",)),
    "ad_blacklist": (("userid",), ()),
    "ad_stat": (("date", "province", "city", "adid"), ("click_count",)),
    "ad_province_top3": (("date", "province", "adid"), ("click_count",)),
    "ad_click_trend": (("date", "hour", "minute", "adid"), ("click_count",)),
}


class MergeDialect:
    """Databases with the standard's MERGE.  Column names are quoted (``date``, ``hour``
    and ``minute`` are reserved in some of them), as Spark's writer quotes them."""

    mark = '"'

    def cols(self, names: Sequence[str], of: str = "") -> str:
        return ", ".join(f"{of}{self.mark}{c}{self.mark}" for c in names)

    def equal(self, keys: Sequence[str], target: str = "t", source: str = "s") -> str:
        return " and ".join(f"{self.cols([k], target + '.')} = {self.cols([k], source + '.')}" for k in keys)

    def upsert(self, table: str, stage: str, keys: Sequence[str], add: Sequence[str], put: Sequence[str], cols: Sequence[str]) -> list[str]:
        """Rows of ``stage`` into ``table`` by ``keys``: of a stored row the columns ``add`` grow by
        the batch's and the columns ``put`` become the batch's."""
        matched = f" when matched then update set {self._update(add, put, 't.')}" if add or put else ""
        return [f"merge into {table} t using {stage} s on {self.equal(keys)}{matched}"
                f" when not matched then insert ({self.cols(cols)}) values ({self.cols(cols, 's.')})"]

    def _update(self, add: Sequence[str], put: Sequence[str], of: str) -> str:
        return ", ".join([f"{self.cols([c])} = {self.cols([c], of)} + {self.cols([c], 's.')}" for c in add]
                         + [f"{self.cols([c])} = {self.cols([c], 's.')}" for c in put])


class DuplicateKeyDialect(MergeDialect):
    """Databases that upsert by ``ON DUPLICATE KEY``; the target's unique key must be the merge key."""

    mark = "`"

    def upsert(self, table, stage, keys, add, put, cols):
        same = f"{self.cols(keys[:1])} = {self.cols(keys[:1], table + '.')}"
        return [f"insert into {table} ({self.cols(cols)}) select {self.cols(cols, 's.')} from {stage} s"
                f" on duplicate key update {self._update(add, put, table + '.') or same}"]


class TableSink(ABC):
    """The five merges of the stream's result tables, each with its batch id.

    A binding says how rows get into a staging table (``stage``, ``unstage``) and how
    statements run in one transaction (``transaction``)."""

    def __init__(self, dialect: MergeDialect | None = None, prefix: str = ""):
        self.dialect = dialect or MergeDialect()
        self.prefix = prefix

    @abstractmethod
    def stage(self, df: DataFrame, table: str) -> None:
        """Write ``df`` to a new table."""

    @abstractmethod
    def unstage(self, table: str) -> None:
        """Drop a staging table if it is there."""

    @abstractmethod
    def transaction(self, known: str, statements: Sequence[str]) -> bool:
        """In one transaction: run ``known`` (a count); if it is 0, run ``statements``, commit
        and return True, else return False.  Any error rolls all of it back."""

    # --- the merges ---------------------------------------------------------------

    def add(self, table: str, df: DataFrame, keys: Sequence[str], values: Sequence[str], batch_id: int) -> bool:
        """SNK2: add the batch's ``values`` to the stored ones."""
        return self._apply(table, df, batch_id, lambda t, s: self.dialect.upsert(t, s, keys, values, [], df.columns))

    def replace(self, table: str, df: DataFrame, keys: Sequence[str], batch_id: int) -> bool:
        """SNK3: the batch's row takes the place of the stored one."""
        values = [c for c in df.columns if c not in keys]
        return self._apply(table, df, batch_id, lambda t, s: self.dialect.upsert(t, s, keys, [], values, df.columns))

    def replace_group(self, table: str, df: DataFrame, group: Sequence[str], batch_id: int) -> bool:
        """SNK4: every group of the batch loses its stored rows."""
        return self._apply(table, df, batch_id, lambda t, s: [
            f"delete from {t} where exists (select 1 from {s} s where {self.dialect.equal(group, t)})", *self._insert(t, s, df)])

    def insert_new(self, table: str, df: DataFrame, keys: Sequence[str], batch_id: int) -> bool:
        """SNK5: rows whose key is not stored; one row for each key."""
        rows = df.dropDuplicates(list(keys))
        return self._apply(table, rows, batch_id, lambda t, s: self.dialect.upsert(t, s, keys, [], [], df.columns))

    def append(self, table: str, df: DataFrame, batch_id: int) -> bool:
        """SNK1 for a stream: the batch's rows, once."""
        return self._apply(table, df, batch_id, lambda t, s: self._insert(t, s, df))

    def _insert(self, table: str, stage: str, df: DataFrame) -> list[str]:
        cols = self.dialect.cols(df.columns)
        return [f"insert into {table} ({cols}) select {cols} from {stage}"]

    def _apply(self, table: str, df: DataFrame, batch_id: int, merge: Callable[[str, str], list[str]]) -> bool:
        target = f"{self.prefix}{table}"
        entry = f"target = '{target}' and batch_id = {int(batch_id)}"
        stage = f"{target}_stage_{int(batch_id)}_{uuid.uuid4().hex[:8]}"
        try:
            self.stage(df, stage)
            return self.transaction(
                f"select count(*) from {self.prefix}{LEDGER} where {entry}",
                [*merge(target, stage), f"insert into {self.prefix}{LEDGER} (target, batch_id) values ('{target}', {int(batch_id)})"])
        finally:
            self.unstage(stage)

    # --- tables -------------------------------------------------------------------

    def tables(self) -> dict[str, str]:
        """Definitions of the ledger and of the stream's five result tables."""
        text = {"date": "varchar(8)", "hour": "varchar(2)", "minute": "varchar(2)", "province": "varchar(64)", "city": "varchar(64)"}
        out = {f"{self.prefix}{LEDGER}": "(target varchar(128) not null, batch_id bigint not null, primary key (target, batch_id))"}
        for name, (keys, values) in RESULT_TABLES.items():
            cols = ", ".join(f"{self.dialect.cols([c])} {text.get(c, 'bigint')} not null" for c in (*keys, *values))
            out[f"{self.prefix}{name}"] = f"({cols}, primary key ({self.dialect.cols(keys)}))"
        return out


class JdbcSink(TableSink):
    """The binding to a database that Spark reaches by JDBC; ``driver`` is its class name,
    on the driver's and the executors' classpath."""

    def __init__(self, spark, url: str, driver: str, properties: dict | None = None, dialect: MergeDialect | None = None,
                 prefix: str = ""):
        super().__init__(dialect, prefix)
        self.spark = spark
        self.url = url
        self.driver = driver
        self.properties = dict(properties or {})

    def stage(self, df: DataFrame, table: str) -> None:
        df.write.jdbc(self.url, table, "errorifexists", {**self.properties, "driver": self.driver})

    def _connection(self):
        jvm = self.spark._jvm
        props = jvm.java.util.Properties()
        for k, v in self.properties.items():
            props.setProperty(k, str(v))
        loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
        c = jvm.java.lang.Class.forName(self.driver, True, loader).getDeclaredConstructor().newInstance().connect(self.url, props)
        c.setAutoCommit(False)
        return c

    def _run(self, work):
        c = self._connection()
        try:
            s = c.createStatement()
            out = work(s)
            c.commit()
            return out
        except Exception:
            c.rollback()
            raise
        finally:
            c.close()

    def transaction(self, known: str, statements: Sequence[str]) -> bool:
        def work(s) -> bool:
            r = s.executeQuery(known)
            r.next()
            if r.getLong(1):
                return False
            for text in statements:
                s.executeUpdate(text)
            return True
        return self._run(work)

    def unstage(self, table: str) -> None:
        def work(s) -> None:
            if s.getConnection().getMetaData().getTables(None, None, table.upper(), None).next() or \
                    s.getConnection().getMetaData().getTables(None, None, table, None).next():
                s.executeUpdate(f"drop table {table}")
        self._run(work)

    def create_tables(self) -> None:
        """Create the ledger and the result tables that are not there yet."""
        def work(s) -> None:
            meta = s.getConnection().getMetaData()
            for name, cols in self.tables().items():
                if not meta.getTables(None, None, name.upper(), None).next() and not meta.getTables(None, None, name, None).next():
                    s.executeUpdate(f"create table {name} {cols}")
        self._run(work)
