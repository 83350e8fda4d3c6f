"""Read and write named tables: parquet folders, catalog tables or JDBC.

A ``Target`` says where a set of tables lives.  Every read and write is a
distributed Spark read or write — executors scan and write their own
partitions; nothing is collected to the driver.

Parquet tables are refreshed by snapshots: data goes into a fresh ``version=`` folder, and
one manifest file then lists the new versions of one or several tables at once
(``shopmart.sources.load``).  Nothing is overwritten; a table's newest listed
versions are what readers see, so all tables of a manifest change together, and a folder
that no manifest lists was never there.  Catalog and JDBC tables are staged and switched
by the same module.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SNAPSHOTS = "_snapshots"
FETCH_ROWS = 10_000   # rows a JDBC connection fetches at a time
JDBC_PARTITIONS = 16  # parallel JDBC range reads unless said otherwise


@dataclass(frozen=True)
class Target:
    kind: str                       # "parquet" | "table" | "jdbc"
    location: str                   # base folder, database name, or JDBC url
    options: dict = field(default_factory=dict)   # JDBC user/password/driver, batchsize …
    versioned: bool = True          # parquet only
    schema: str | None = None       # database schema of a JDBC target's tables

    @staticmethod
    def parquet(base: str, versioned: bool = True) -> "Target":
        return Target("parquet", base.rstrip("/"), versioned=versioned)

    @staticmethod
    def table(database: str) -> "Target":
        return Target("table", database)

    @staticmethod
    def jdbc(url: str, schema: str | None = None, **options) -> "Target":
        """``options`` go to Spark's JDBC source; ``fetchsize`` has a default, and on
        PostgreSQL ``cascadeTruncate``, which it needs to empty a referenced table."""
        defaults = {"fetchsize": str(FETCH_ROWS)}
        if url.startswith("jdbc:postgresql:"):
            defaults["cascadeTruncate"] = "true"
        return Target("jdbc", url, options={**defaults, **options}, schema=schema)

    def dbtable(self, name: str) -> str:
        return f"{self.schema}.{name}" if self.schema else name


def jdbc_target_from_env(env=None, prefix: str = "POSTGRES_",
                         schema: str | None = None) -> Target:
    """A PostgreSQL JDBC target from ``{prefix}USER/PASSWORD/HOST/INTERNAL_PORT/DB``.

    Defaults: user and password ``postgres``, host ``postgres``, port 5432,
    database ``postgres``; the driver class is the PostgreSQL one.
    """
    env = os.environ if env is None else env
    get = lambda k, d: env.get(prefix + k, d)
    url = "jdbc:postgresql://%s:%s/%s" % (get("HOST", "postgres"), get("INTERNAL_PORT", "5432"),
                                           quote(get("DB", "postgres")))
    return Target.jdbc(url, schema=schema, user=get("USER", "postgres"),
                       password=get("PASSWORD", "postgres"), driver="org.postgresql.Driver")


class SchemaDrift(ValueError):
    """Columns of a file that are missing or of another type than declared."""


# Schemes that a task can open by itself, and pyarrow's name for them.
_OPENED = {"": "file", "file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "s3n": "s3",
           "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def _open_parquet(path: str, content: bytes | None):
    """The footer of a parquet file, from its bytes if given, otherwise by its path."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    if content is not None:
        return pq.ParquetFile(pa.BufferReader(content))
    parts = urlsplit(path)
    kind = _OPENED[parts.scheme]
    if kind == "file":
        return pq.ParquetFile(unquote(parts.path) if "%" in path and not os.path.exists(parts.path)
                              else parts.path)
    system, inner = fs.FileSystem.from_uri(f"{kind}://{path.split('://', 1)[1]}")
    return pq.ParquetFile(system.open_input_file(inner))


def _columns(path: str, content: bytes | None) -> list[tuple[str, str]]:
    """(top-level column, its physical and logical types) of a file."""
    with _open_parquet(path, content) as file:
        schema, found = file.schema, {}
        for i in range(len(schema)):
            leaf = schema.column(i)
            kind = f"{leaf.path} {leaf.physical_type} {leaf.logical_type} {leaf.length}"
            found.setdefault(leaf.path.split(".")[0], []).append(kind)
    return [(name, "; ".join(kinds)) for name, kinds in found.items()]


def _task_can_open(path: str) -> bool:
    try:
        _columns(path, None)
    except Exception:  # a store that only Spark's readers reach
        return False
    return True


def footers(spark: SparkSession, path_or_glob: str) -> DataFrame:
    """(file, column, kind) of every parquet file: one row for each of its top-level columns.

    Tasks read the footers.  In a store that tasks cannot open by themselves Spark's binary
    reader hands them the files' bytes, which costs reading the files.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path_or_glob)
    files = files.where(F.col("length") > 0)
    one = files.select("path").first()
    columns = ["path"] if one is None or _task_can_open(one.path) else ["path", "content"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(row["path"], name, kind) for row in batch.to_pylist()
                    for name, kind in _columns(row["path"], row.get("content"))]
            yield pa.RecordBatch.from_pylist([dict(zip(("file", "column", "kind"), r)) for r in rows],
                                             pa.schema([(c, pa.string()) for c in ("file", "column", "kind")]))

    return files.select(*columns).mapInArrow(read, "file string, column string, kind string")


def check_schema(spark: SparkSession, path: str, schema: T.StructType, every_file: bool = True) -> None:
    """Raise ``SchemaDrift`` unless every file has each declared column with its type.

    Spark reads a missing column as NULL when a schema is given, and takes the schema of
    one file for that of all.  Here the footers of all files are read (in tasks) and grouped by
    what they say of the declared columns; of each distinct group, usually one, Spark itself tells the
    types from one file.  Further columns are allowed (and not read).  ``every_file=False``
    looks at one file, for folders that a single job wrote.
    """
    wrong = []
    if not every_file:
        wrong = _differences(spark, path, schema)
    else:
        declared = F.col("column").isin(*schema.names)
        per_file = footers(spark, path).groupBy("file").agg(F.array_sort(F.collect_list(
            F.when(declared, F.concat_ws(" ", "column", "kind")))).alias("kinds"))
        groups = per_file.groupBy("kinds").agg(F.min("file").alias("file"), F.count("*").alias("n"))
        for group in groups.orderBy("file").collect():
            found = _differences(spark, group.file, schema)
            wrong += [f"{d} (in {group.n} files, such as {group.file})" for d in found]
    if wrong:
        raise SchemaDrift(f"{path}: " + "; ".join(wrong))


def _differences(spark: SparkSession, path: str, schema: T.StructType) -> list[str]:
    found = {f.name: f.dataType for f in spark.read.parquet(path).schema.fields}
    return [f"{f.name} is missing" if f.name not in found else
            f"{f.name} is {found[f.name].simpleString()}, not {f.dataType.simpleString()}"
            for f in schema.fields if found.get(f.name) != f.dataType]


def read_files(spark: SparkSession, path_or_glob: str, schema: T.StructType) -> DataFrame:
    """Scan parquet files by path or glob (``…/raw/*.parquet``) with a declared schema."""
    check_schema(spark, path_or_glob, schema)
    return spark.read.schema(schema).parquet(path_or_glob)


def _path(target: Target, name: str) -> str:
    return f"{target.location}/{name}"


_MANIFEST = "id bigint, tables map<string, array<string>>, sequences map<string, bigint>"


def manifests(spark: SparkSession, target: Target) -> DataFrame:
    """(id, tables, sequences): one row per published manifest of a parquet target."""
    lines = spark.read.option("recursiveFileLookup", "true").text(f"{target.location}/{SNAPSHOTS}")
    return lines.select(F.from_json("value", _MANIFEST).alias("m")).select("m.*")


def snapshot(spark: SparkSession, target: Target) -> dict[str, list[str]]:
    """Table → its listed version folders, newest manifest first; a missing list is an error.

    A manifest is one short line per refresh; one row per table comes back.
    """
    rows = (manifests(spark, target).select("id", F.explode("tables").alias("name", "versions"))
            .groupBy("name").agg(F.max_by("versions", "id").alias("versions")).collect())
    return {r.name: list(r.versions) for r in rows}


def version_paths(spark: SparkSession, target: Target, name: str,
                  known: dict[str, list[str]] | None = None) -> list[str]:
    """The folders that make up a versioned table in a snapshot (the newest unless given)."""
    versions = (snapshot(spark, target) if known is None else known).get(name)
    if not versions:
        raise FileNotFoundError(f"no finished version of {_path(target, name)}")
    return [f"{_path(target, name)}/{v}" for v in versions]


def _jdbc_reader(spark: SparkSession, target: Target, dbtable: str):
    reader = (spark.read.format("jdbc").option("url", target.location)
              .option("dbtable", dbtable))
    for k, v in target.options.items():
        reader = reader.option(k, v)
    return reader


def read_table(spark: SparkSession, target: Target, name: str,
               schema: T.StructType | None = None, partition_column: str | None = None,
               lower_bound: int | None = None, upper_bound: int | None = None,
               num_partitions: int | None = None,
               known: dict[str, list[str]] | None = None) -> DataFrame:
    """Read table ``name``; with ``schema`` a drifted parquet file raises ``SchemaDrift``.

    All files of an unversioned folder are checked, and one of each version, which a single job wrote.
    ``known`` is a ``snapshot`` taken before, so that several tables are read as of one moment.
    For JDBC, ``partition_column`` and ``num_partitions`` split the scan into
    parallel range queries instead of one connection; bounds not given are
    asked of the database as a ``MIN``/``MAX`` subquery (a single row).
    """
    if target.kind == "parquet":
        if not target.versioned:
            path = _path(target, name)
            return read_files(spark, path, schema) if schema is not None else spark.read.parquet(path)
        paths = version_paths(spark, target, name, known)
        if schema is None:
            return spark.read.parquet(*paths)
        for path in paths:
            check_schema(spark, path, schema, every_file=False)
        return spark.read.schema(schema).parquet(*paths)
    if target.kind == "table":
        return spark.table(f"{target.location}.{name}")
    if target.kind == "jdbc":
        reader = _jdbc_reader(spark, target, target.dbtable(name))
        if partition_column:
            if lower_bound is None or upper_bound is None:
                lower_bound, upper_bound = _jdbc_bounds(spark, target, name, partition_column)
                if lower_bound is None:          # empty table: one partition is enough
                    return reader.load()
            reader = (reader.option("partitionColumn", partition_column)
                      .option("lowerBound", lower_bound).option("upperBound", upper_bound)
                      .option("numPartitions", num_partitions or JDBC_PARTITIONS))
        return reader.load()
    raise ValueError(f"unknown target kind {target.kind!r}")


def pushed_table(spark: SparkSession, target: Target, name: str, catalog: str = "jdbc_mart") -> DataFrame:
    """A JDBC table through Spark's JDBC catalog: filters and aggregates over it run in the database.

    So a report reads one row per group instead of the table.  ORDER BY … LIMIT goes down as well on
    PostgreSQL; other dialects may not know LIMIT, and Spark cuts their result itself.
    """
    known = target.location.startswith("jdbc:postgresql:")
    options = {"": "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog",
               ".url": target.location, ".pushDownLimit": str(known).lower(),
               **{f".{k}": v for k, v in target.options.items() if k != "cascadeTruncate"}}
    for key, value in options.items():
        spark.conf.set(f"spark.sql.catalog.{catalog}{key}", value)
    schema = target.schema or ("public" if known else "APP")
    return spark.table(f"`{catalog}`.`{schema}`.`{name}`")


def bounds_query(target: Target, name: str, column: str) -> str:
    """The MIN/MAX subquery that stands for a table in a JDBC read (``column`` as SQL)."""
    return f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {target.dbtable(name)}) b"


def _jdbc_bounds(spark: SparkSession, target: Target, name: str, column: str):
    """MIN/MAX of ``column``, computed by the database."""
    dialect = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(target.location)
    query = bounds_query(target, name, dialect.quoteIdentifier(column))
    row = _jdbc_reader(spark, target, query).load().first()
    return (row[0], row[1]) if row is not None else (None, None)


def _writer(df: DataFrame, mode: str, partition_by: list[str] | None,
            max_records_per_file: int | None = None):
    writer = df.write.mode(mode)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    return writer.partitionBy(*partition_by) if partition_by else writer


def rebalanced(df: DataFrame, partition_by: list[str] | None) -> DataFrame:
    """Rows of a folder in a few tasks, so it gets a few files of the advised size; AQE splits
    large folders over several tasks."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def new_version() -> str:
    return "version=%d" % time.time_ns()


def write_version(df: DataFrame, target: Target, name: str, partition_by: list[str] | None = None,
                  max_records_per_file: int | None = None) -> str:
    """Write ``df`` into a fresh version folder that no manifest lists yet; returns its name."""
    version = new_version()
    _writer(rebalanced(df, partition_by), "error", partition_by, max_records_per_file).parquet(
        f"{_path(target, name)}/{version}")
    return version


def jdbc_writer(df: DataFrame, target: Target, name: str, mode: str):
    writer = (df.write.format("jdbc").mode(mode).option("url", target.location)
              .option("dbtable", target.dbtable(name)))
    for k, v in target.options.items():
        writer = writer.option(k, v)
    return writer


def write_table(df: DataFrame, target: Target, name: str, mode: str = "overwrite",
                partition_by: list[str] | None = None,
                max_records_per_file: int | None = None) -> str:
    """Write ``df`` as table ``name`` and make it visible; returns where the data went.

    ``max_records_per_file`` splits each task's output into files of at
    most that many rows (no shuffle), so a small table written by few tasks
    can still be scanned by many.  With ``partition_by`` the rows are rebalanced
    by those columns first.  A JDBC write here commits task by task;
    ``shopmart.sources.load`` loads JDBC tables in one transaction.
    """
    if target.kind == "parquet":
        path = _path(target, name)
        if not target.versioned or mode != "overwrite":
            _writer(rebalanced(df, partition_by), mode, partition_by, max_records_per_file).parquet(path)
            return path
        version = write_version(df, target, name, partition_by, max_records_per_file)
        publish_manifest(df.sparkSession, target, {name: [version]})
        return f"{path}/{version}"
    if target.kind == "table":
        _writer(rebalanced(df, partition_by), mode, partition_by).format("parquet").saveAsTable(
            f"{target.location}.{name}")
        return f"{target.location}.{name}"
    if target.kind == "jdbc":
        writer = jdbc_writer(df, target, name, mode)
        if mode == "overwrite":
            writer = writer.option("truncate", "true")
        writer.save()
        return f"{target.location}#{name}"
    raise ValueError(f"unknown target kind {target.kind!r}")


def publish_manifest(spark: SparkSession, target: Target, tables: dict[str, list[str]],
                     sequences: dict[str, int] | None = None) -> None:
    """List new versions of several tables in one file: they all become visible, or none.

    Each manifest has a folder of its own, so publishers do not meet; the file appears
    by the one rename that commits the write.
    """
    stamp = time.time_ns()
    line = json.dumps({"id": stamp, "tables": tables, "sequences": sequences or {}})
    (spark.createDataFrame([(line,)], "value string").coalesce(1)
     .write.mode("error").text(f"{target.location}/{SNAPSHOTS}/{stamp}"))
