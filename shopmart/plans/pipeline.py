"""The two jobs: raw → seven checked core tables, and core → two marts.

Each job is one Spark application.  Tables are written by the executors, staged where no
reader looks, checked there, and published together (``shopmart.sources.load``).  Row counts come
from the committed files' footers (or the staging table), so a repeated task cannot count twice.
Violations of the core contracts are returned as DataFrames (and written aside when a target is
given), or make the load fail before it is visible.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmart.contracts import CORE, DM_ITEMS, DM_ORDERS, FOREIGN_KEYS, LOAD_ORDER, RAW, conform
from shopmart.operators import items_mart, normalize, orders_mart, quality
from shopmart.operators.cleaning import fill_defaults, with_surrogate_key
from shopmart.sources.io import (JDBC_PARTITIONS, Target, read_files, read_table, snapshot,
                                 write_table)
from shopmart.sources.load import Load, refresh_views, sequence_mark

SEQUENCE_KEYS = {
    "order_items": ("order_item_sk", normalize.ORDER_ITEM_COLUMNS),
    "order_drivers": ("order_driver_sk", ("order_id", "driver_id")),
}


@dataclass
class RunResult:
    written: dict[str, str] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    violations: dict[str, DataFrame] = field(default_factory=dict)


def _stage(load: Load, df: DataFrame, name: str, result: RunResult, **options) -> None:
    result.written[name] = load.write(df, name, **options)
    result.rows[name] = load.rows(name)


def run_concurrently(tasks: dict[str, Callable[[], object]], workers: int = 8) -> dict:
    """Submit independent Spark jobs from a few driver threads.

    Each task is one or more distributed jobs; running them side by side
    lets small jobs (dimension tables, checks) fill executor slots that a
    single job leaves idle.  Results come back by name.
    """
    if workers <= 1 or len(tasks) <= 1:
        return {name: task() for name, task in tasks.items()}
    with ThreadPoolExecutor(max_workers=min(workers, len(tasks))) as pool:
        futures = {name: pool.submit(task) for name, task in tasks.items()}
        return {name: f.result() for name, f in futures.items()}


def core_table(filled: DataFrame, name: str) -> DataFrame:
    """One core table (with its sequence key, if any) in contract shape."""
    df = normalize.CORE_BUILDERS[name](filled)
    if name in SEQUENCE_KEYS:
        key, order = SEQUENCE_KEYS[name]
        df = with_surrogate_key(df, key, order)
    return conform(df, CORE[name])


def core_tables(raw: DataFrame) -> dict[str, DataFrame]:
    """The seven core tables (with sequence keys) from a raw frame, in contract shape."""
    filled = fill_defaults(raw)
    return {name: core_table(filled, name) for name in LOAD_ORDER}


def core_violations(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every core constraint family as a violations DataFrame (lazy)."""
    v: dict[str, DataFrame] = {}
    for name, contract in CORE.items():
        v[f"not_null_{name}"] = quality.check_not_null(tables[name], contract)
        v[f"unique_{name}"] = quality.check_unique(tables[name], contract.key)
        for key in contract.unique:
            v[f"unique_{name}_{'_'.join(key)}"] = quality.check_unique(tables[name], key, True)
    for fk in FOREIGN_KEYS:
        v[fk.name] = quality.check_foreign_key(tables[fk.child], fk.column,
                                               tables[fk.parent], fk.parent_key)
    for table in ("order_items", "orders"):
        v[f"checks_{table}"] = quality.check_rules(tables[table], table)
    return v


def run_extract(spark: SparkSession, raw_glob: str, staging: Target,
                raw_name: str = "raw") -> RunResult:
    """Copy the raw parquet files (path or glob) into staging, schema-checked."""
    result, load = RunResult(), Load(spark, staging)
    _stage(load, read_files(spark, raw_glob, RAW.schema), raw_name, result)
    load.publish()
    return result


class ConstraintViolation(ValueError):
    """Raised by ``run_etl(..., fail_on_violation=True)``; carries the counts."""

    def __init__(self, counts: dict[str, int]):
        super().__init__("core constraints violated: " + ", ".join(
            f"{k}={v}" for k, v in sorted(counts.items())))
        self.counts = counts


def count_core_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(check_name, violations) of every core constraint, in one job over the seven tables."""
    return quality.count_violations(tables, CORE, FOREIGN_KEYS, ("order_items", "orders"))


def run_etl(spark: SparkSession, raw_source: Target | DataFrame, core_target: Target,
            raw_name: str = "raw", violations_target: Target | None = None,
            workers: int = 4, fail_on_violation: bool = False,
            jdbc_partitions: int = JDBC_PARTITIONS) -> RunResult:
    """Raw order lines → seven core tables; constraint report.

    ``raw_source`` is a target holding ``raw_name`` (files whose columns
    differ from the RAW contract raise before anything is written) or a
    ready DataFrame.
    The seven tables are staged by independent, concurrent jobs; checks run over the staged
    tables, so they re-read compact parquet instead of recomputing the split.  Then all seven are
    published at once, parents before children in a database.
    With ``fail_on_violation`` the job raises ``ConstraintViolation`` when
    any check finds a row, as a database with enforced constraints would
    reject the load, and readers keep the tables they had; by default violations are
    only reported.
    """
    raw = raw_source if isinstance(raw_source, DataFrame) else \
        read_table(spark, raw_source, raw_name, schema=RAW.schema)
    filled = fill_defaults(raw)
    result, load = RunResult(), Load(spark, core_target)
    _stage_all(load, {n: core_table(filled, n) for n in LOAD_ORDER}, result, workers)
    tables = {n: load.read(n, **_split(core_target, n, jdbc_partitions)) for n in LOAD_ORDER}
    staged = core_violations(tables)
    if violations_target is not None:
        run_concurrently({name: (lambda n=name, df=df: write_table(df, violations_target, n))
                          for name, df in staged.items()}, workers)
    if fail_on_violation:
        bad = {r.check_name: r.violations for r in count_core_violations(tables).collect() if r.violations}
        if bad:
            load.discard()
            raise ConstraintViolation(bad)
    load.publish(LOAD_ORDER, sequence_marks(result.rows))
    result.violations = staged if core_target.kind == "parquet" else \
        core_violations(read_core(spark, core_target, jdbc_partitions))
    return result


def append_rows(spark: SparkSession, core_target: Target, name: str, rows: DataFrame) -> RunResult:
    """Append rows to a core table; its sequence key goes on where it stood (a full load starts at 1).

    ``rows`` have the table's columns without the key.  One appender at a time: the mark is read first and
    written with the new rows.
    """
    key, order = SEQUENCE_KEYS[name]
    mark = sequence_mark(spark, core_target, name, key)
    result, load = RunResult(), Load(spark, core_target, append=True)
    _stage(load, conform(with_surrogate_key(rows, key, order, after=mark), CORE[name]), name, result)
    load.publish(sequences={name: mark + result.rows[name]})
    return result


def sequence_marks(rows: dict[str, int]) -> dict[str, int]:
    """The last value of each table's sequence key after a full load: keys run from 1."""
    return {name: rows[name] for name in SEQUENCE_KEYS}


def _stage_all(load: Load, tables: dict[str, DataFrame], result: RunResult, workers: int,
               **options) -> None:
    run_concurrently({n: (lambda n=n, df=df: _stage(load, df, n, result, **options))
                      for n, df in tables.items()}, workers)


def run_load(spark: SparkSession, core_source: Target, target: Target,
             jdbc_partitions: int = JDBC_PARTITIONS, workers: int = 4) -> RunResult:
    """Copy built core tables into another target (typically JDBC), visible all at once.

    Each table is written by the executors over parallel connections; a database then
    moves the staged rows in one transaction, parents before children.
    """
    result, load = RunResult(), Load(spark, target)
    _stage_all(load, read_core(spark, core_source, jdbc_partitions), result, workers)
    load.publish(LOAD_ORDER, sequence_marks(result.rows))
    return result


def marts(core: dict[str, DataFrame], **item_options) -> dict[str, DataFrame]:
    """Core tables → conformed ``dm_orders`` and ``dm_items`` (lazy).

    ``item_options`` go to ``items_mart.with_ranks`` (``iso_year``, ``method``).
    """
    dm_orders = orders_mart.build_dm_orders(core["orders"], core["order_items"],
                                            core["order_drivers"], core["stores"])
    oe = orders_mart.orders_enriched(core["orders"], core["stores"])
    dm_items = items_mart.build_dm_items(oe, core["order_items"], core["items"], core["stores"],
                                         **item_options)
    return {"dm_orders": dm_orders, "dm_items": dm_items}


# Range-partitioning columns for parallel JDBC reads of the core tables.
JDBC_SPLIT = {"users": "user_id", "stores": "store_id", "drivers": "driver_id",
              "items": "item_id", "orders": "order_id", "order_items": "order_item_sk",
              "order_drivers": "order_driver_sk"}


def _split(source: Target, name: str, partitions: int) -> dict:
    """How a core table of a target is read: its schema, or parallel key ranges."""
    if source.kind == "jdbc":
        return {"partition_column": JDBC_SPLIT[name], "num_partitions": partitions}
    return {"schema": CORE[name].schema}


def read_core(spark: SparkSession, source: Target,
              jdbc_partitions: int = JDBC_PARTITIONS) -> dict:
    """The seven core tables as of one snapshot; JDBC sources are read as parallel key ranges."""
    known = snapshot(spark, source) if source.kind == "parquet" and source.versioned else None
    return {name: read_table(spark, source, name, known=known, **_split(source, name, jdbc_partitions))
            for name in CORE}


def run_marts(spark: SparkSession, core_source: Target, mart_target: Target,
              partition_by: list[str] | None = None, workers: int = 2,
              jdbc_partitions: int = JDBC_PARTITIONS, views: str | None = None,
              **item_options) -> RunResult:
    """Core tables → both marts with the audit column, written concurrently, visible together.

    ``views`` names a catalog database whose views ``dm_orders`` and ``dm_items`` then show the new
    marts (parquet targets); ``item_options`` are those of ``marts``.
    """
    contracts = {"dm_orders": DM_ORDERS, "dm_items": DM_ITEMS}
    built = marts(read_core(spark, core_source, jdbc_partitions), **item_options)
    result, load = RunResult(), Load(spark, mart_target)
    _stage_all(load, {n: conform(df, contracts[n], audit=True) for n, df in built.items()}, result, workers,
               partition_by=partition_by)
    load.publish()
    if views is not None:
        refresh_views(spark, mart_target, {n: c.schema for n, c in contracts.items()}, views)
    return result
