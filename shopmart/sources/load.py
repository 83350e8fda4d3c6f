"""Loads that become visible all at once, after their checks.

A ``Load`` stages any number of tables, lets them be read back and checked, and then publishes them
together: parquet versions by one manifest, JDBC tables by one transaction in the database, catalog
tables by renaming.  Until then readers see the tables as they were; a load that is rejected or
dies leaves staged data that nobody lists (``clean`` removes it).

JDBC: every row is staged with its task's partition and attempt.  A task that was repeated after its
insert has staged its partition twice; before publishing, one whole attempt of each partition stays.
Rows never pass through the driver: the database moves them from the staging tables.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopmart.sources.io import (SNAPSHOTS, Target, jdbc_writer, manifests, publish_manifest, read_table,
                                 rebalanced, snapshot, version_paths, write_table, write_version)

PART, ATTEMPT = "load_part", "load_attempt"


def with_attempt(df: DataFrame) -> DataFrame:
    """``df`` with the partition and the task attempt that each row came through."""

    def stamped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        for batch in batches:
            stamps = [pa.array([value] * batch.num_rows, pa.int64())
                      for value in (task.partitionId(), task.taskAttemptId())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *stamps],
                                             [*batch.schema.names, PART, ATTEMPT])

    extra = [T.StructField(name, T.LongType()) for name in (PART, ATTEMPT)]
    return df.mapInArrow(stamped, T.StructType([*df.schema.fields, *extra]))


class Database:
    """A JDBC connection of the driver; used for statements, never for rows."""

    def __init__(self, spark: SparkSession, target: Target):
        jvm = spark._jvm
        if "driver" in target.options:
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(
                target.options["driver"])
        properties = jvm.java.util.Properties()
        for key in ("user", "password"):
            if key in target.options:
                properties.setProperty(key, target.options[key])
        self.connection = jvm.java.sql.DriverManager.getConnection(target.location, properties)
        self.connection.setAutoCommit(False)
        self.dialect = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(target.location)

    def __enter__(self) -> Database:
        return self

    def __exit__(self, *error) -> None:
        try:
            self.connection.rollback()  # what was not committed
        finally:
            self.connection.close()

    def run(self, sql: str) -> int:
        """Run a statement; the number of rows it changed."""
        statement = self.connection.createStatement()
        try:
            return statement.executeUpdate(sql)
        finally:
            statement.close()

    def rows(self, sql: str) -> list[tuple]:
        """Rows of a query with a small result."""
        statement = self.connection.createStatement()
        try:
            found, out = statement.executeQuery(sql), []
            width = found.getMetaData().getColumnCount()
            while found.next():
                out.append(tuple(found.getObject(i + 1) for i in range(width)))
            return out
        finally:
            statement.close()

    def columns(self, table: str) -> list[str]:
        """Quoted column names of a table, as the database spells them."""
        statement = self.connection.createStatement()
        try:
            meta = statement.executeQuery(f"SELECT * FROM {table} WHERE 1 = 0").getMetaData()
            return [self.dialect.quoteIdentifier(meta.getColumnName(i + 1))
                    for i in range(meta.getColumnCount())]
        finally:
            statement.close()

    def commit(self) -> None:
        self.connection.commit()


class Load:
    """Tables staged in ``target``; ``publish`` shows them all, ``discard`` none.

    An unversioned parquet folder has no place to stage: it is overwritten at once.
    With ``append`` the staged rows join those that the tables hold.
    """

    def __init__(self, spark: SparkSession, target: Target, append: bool = False):
        if append and (target.kind == "table" or not target.versioned):
            raise ValueError("appending needs a versioned parquet or a JDBC target")
        self.spark, self.target, self.append = spark, target, append
        self.run = time.time_ns()
        self.versions: dict[str, list[str]] = {}
        self.staged: dict[str, str] = {}

    def _stage_name(self, name: str) -> str:
        return f"{name}_load_{self.run}"

    def write(self, df: DataFrame, name: str, partition_by: Sequence[str] | None = None) -> str:
        """Stage ``df`` as the new content of table ``name``; returns where it lies."""
        partition_by = list(partition_by) if partition_by else None
        if self.target.kind == "parquet" and not self.target.versioned:
            return write_table(df, self.target, name, partition_by=partition_by)  # shown as it is written
        if self.target.kind == "parquet":
            version = write_version(df, self.target, name, partition_by)
            self.versions[name] = [version]
            return f"{self.target.location}/{name}/{version}"
        stage = self._stage_name(name)
        self.staged[name] = stage
        if self.target.kind == "table":
            writer = rebalanced(df, partition_by).write.mode("error").format("parquet")
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            writer.saveAsTable(f"{self.target.location}.{stage}")
        else:
            self._write_jdbc(df, name, stage)
        return f"{self.target.location}#{name}"

    def _write_jdbc(self, df: DataFrame, name: str, stage: str) -> None:
        """Stage into a table with the target's own column types; the target is made if it is new."""
        jdbc_writer(df.limit(0), self.target, name, "ignore").save()
        table, staging = self.target.dbtable(name), self.target.dbtable(stage)
        with Database(self.spark, self.target) as db:
            listed = ", ".join(db.columns(table))
            db.run(f"CREATE TABLE {staging} AS SELECT {listed} FROM {table} WITH NO DATA")
            for extra in (PART, ATTEMPT):
                db.run(f"ALTER TABLE {staging} ADD COLUMN {db.dialect.quoteIdentifier(extra)} BIGINT")
            db.commit()
        jdbc_writer(with_attempt(df), self.target, stage, "append").save()

    def read(self, name: str, **options) -> DataFrame:
        """A staged table."""
        if self.target.kind == "parquet":
            known = self.versions if self.target.versioned else None
            return read_table(self.spark, self.target, name, known=known, **options)
        return read_table(self.spark, self.target, self.staged[name], **options).drop(PART, ATTEMPT)

    def rows(self, name: str) -> int:
        """Rows of a staged table: of parquet by the footers of the committed files."""
        if self.target.kind != "jdbc":
            return self.read(name).count()
        with Database(self.spark, self.target) as db:
            self._keep_one_attempt(db, name)
            count = db.rows(f"SELECT COUNT(*) FROM {self.target.dbtable(self.staged[name])}")[0][0]
            db.commit()
        return int(count)

    def _keep_one_attempt(self, db: Database, name: str) -> None:
        """Delete what repeated tasks staged twice: of each partition the fullest attempt stays.

        One row per task comes to the driver.
        """
        part, attempt = (db.dialect.quoteIdentifier(c) for c in (PART, ATTEMPT))
        staging, kept = self.target.dbtable(self.staged[name]), {}
        tried = db.rows(f"SELECT {part}, {attempt}, COUNT(*) FROM {staging} GROUP BY {part}, {attempt}")
        for p, a, n in tried:
            kept[p] = max(kept.get(p, (-1, 0)), (int(n), -int(a)))
        for p, a, _ in tried:
            if -int(a) != kept[p][1]:
                db.run(f"DELETE FROM {staging} WHERE {part} = {p} AND {attempt} = {a}")

    def publish(self, order: Sequence[str] | None = None, sequences: dict[str, int] | None = None) -> None:
        """Make all staged tables visible together; ``order`` names parents before children.

        A database that refuses a row keeps its old rows, and the staging tables go.
        """
        if self.target.kind == "parquet":
            if self.target.versioned:
                held = snapshot(self.spark, self.target) if self.append else {}
                publish_manifest(self.spark, self.target,
                                 {n: held.get(n, []) + v for n, v in self.versions.items()}, sequences)
            return
        order = [n for n in (order or self.staged) if n in self.staged]
        if self.target.kind == "table":
            for name in order:
                self._swap(name)
            return
        try:
            self._move(order)
        finally:
            self.discard()

    def _move(self, order: list[str]) -> None:
        """The closing transaction: old rows out, staged rows in."""
        with Database(self.spark, self.target) as db:
            tables = {n: self.target.dbtable(n) for n in order}
            for name in order:
                self._keep_one_attempt(db, name)
            if self.append:
                pass  # the old rows stay
            elif self.target.location.startswith("jdbc:postgresql:"):
                db.run(f"TRUNCATE TABLE {', '.join(tables.values())} RESTART IDENTITY CASCADE")
            else:
                for name in reversed(order):
                    db.run(f"DELETE FROM {tables[name]}")
            for name in order:
                extra = {db.dialect.quoteIdentifier(c).lower() for c in (PART, ATTEMPT)}
                staging = self.target.dbtable(self.staged[name])
                listed = ", ".join(c for c in db.columns(staging) if c.lower() not in extra)
                db.run(f"INSERT INTO {tables[name]} ({listed}) SELECT {listed} FROM {staging}")
            db.commit()

    def _swap(self, name: str) -> None:
        """Put a staged catalog table in the old one's place."""
        full, stage = (f"{self.target.location}.{n}" for n in (name, self.staged[name]))
        old = f"{self.target.location}.{name}_old_{self.run}"
        existed = self.spark.catalog.tableExists(full)
        if existed:
            self.spark.sql(f"ALTER TABLE {full} RENAME TO {old}")
        self.spark.sql(f"ALTER TABLE {stage} RENAME TO {full}")
        if existed:
            self.spark.sql(f"DROP TABLE {old}")

    def discard(self) -> None:
        """Drop what is staged in a database; unlisted parquet folders are left to ``clean``."""
        if self.target.kind == "table":
            for stage in self.staged.values():
                self.spark.sql(f"DROP TABLE IF EXISTS {self.target.location}.{stage}")
        elif self.target.kind == "jdbc" and self.staged:
            with Database(self.spark, self.target) as db:
                for stage in self.staged.values():
                    db.run(f"DROP TABLE {self.target.dbtable(stage)}")
                db.commit()
        self.staged.clear()


def sequence_mark(spark: SparkSession, target: Target, name: str, key: str) -> int:
    """The last value that a table's sequence key has reached; 0 before the first.

    Parquet: as the newest manifest of the table tells; JDBC: the largest key in the table.
    """
    if target.kind == "jdbc":
        with Database(spark, target) as db:
            found = db.rows(f"SELECT MAX({db.dialect.quoteIdentifier(key)}) FROM {target.dbtable(name)}")[0][0]
    else:
        told = manifests(spark, target).where(F.col("sequences")[name].isNotNull())
        found = told.agg(F.max_by(F.col("sequences")[name], F.col("id"))).first()[0]
    return int(found or 0)


def refresh_views(spark: SparkSession, target: Target, schemas: dict[str, T.StructType],
                  database: str | None = None) -> None:
    """SQL views of a parquet target's tables at its newest snapshot.

    With ``database`` they are catalog views, to be refreshed after each publishing (``run_marts(views=…)``
    does); otherwise views of this session.
    """
    known = snapshot(spark, target)
    for name, schema in schemas.items():
        paths = version_paths(spark, target, name, known)
        if database is None:
            spark.read.schema(schema).parquet(*paths).createOrReplaceTempView(name)
            continue
        listed = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema)
        parts = " UNION ALL ".join(f"SELECT {listed} FROM parquet.`{path}`" for path in paths)
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {parts}")


def clean(spark: SparkSession, target: Target, keep: int = 1, grace_hours: float = 24) -> list[str]:
    """Remove version folders of a parquet target that none of a table's newest ``keep`` manifests
    lists, and manifests that list nothing else; returns the removed folders.

    What is younger than ``grace_hours`` stays: a load may be about to list it, and readers may
    still be on it.  One row per kept version and one listing per table come to the driver.
    """
    listed = manifests(spark, target).select("id", F.explode("tables").alias("name", "versions"))
    newest = {(r.name, v) for r in listed.groupBy("name").agg(F.slice(F.sort_array(F.collect_list(
        F.struct("id", "versions")), False), 1, keep).alias("kept")).collect()
        for k in r.kept for v in k.versions}
    kept_ids = {r.id for r in listed.groupBy("name").agg(F.slice(F.sort_array(
        F.collect_list("id"), False), 1, keep).alias("ids")).select(F.explode("ids").alias("id")).collect()}
    jvm, removed = spark._jvm, []
    path = lambda *parts: jvm.org.apache.hadoop.fs.Path("/".join([target.location, *parts]))
    system = path().getFileSystem(spark._jsc.hadoopConfiguration())
    before = time.time_ns() - int(grace_hours * 3600e9)
    names = lambda *parts: [f.getPath().getName() for f in system.listStatus(path(*parts))]
    for name in names():
        if name == SNAPSHOTS:
            old = [(name, f) for f in names(name) if f.isdigit() and int(f) not in kept_ids and int(f) < before]
        else:
            old = [(name, f) for f in names(name) if f.startswith("version=") and (name, f) not in newest
                   and int(f.split("=")[1]) < before]
        for parts in old:
            system.delete(path(*parts), True)
            removed.append("/".join(parts))
    return removed
