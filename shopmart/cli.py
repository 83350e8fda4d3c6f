"""Command line for the jobs (for ``spark-submit`` or a scheduler).

    python -m shopmart extract --raw 's3a://…/raw/*.parquet' --stage s3a://…/stage
    python -m shopmart etl     --stage s3a://…/stage --core s3a://…/core [--violations …]
    python -m shopmart load    --core s3a://…/core --to jdbc:postgresql://db:5432/shop
    python -m shopmart marts   --core s3a://…/core --dm s3a://…/dm [--partition-by-month]
    python -m shopmart report  q1_weekday_totals --dm s3a://…/dm [--out s3a://…/reports]
    python -m shopmart sql     "SELECT … FROM dm_items …" --dm s3a://…/dm [--core …]
    python -m shopmart clean   s3a://…/core --keep 2 --grace-hours 24

Every command prints one JSON line with the tables written and their row
counts; ``report`` without ``--out`` and ``sql`` print every row as a JSON line.
``etl --fail-on-violation`` ends with exit code 1 and the counts of broken constraints when
there are any, and leaves the tables as they were.  ``sql`` runs any Spark SQL over the newest
marts and core tables; ``marts --views DB`` also keeps catalog views of the marts.
Targets are parquet folders, ``table:<database>`` for catalog
tables, or ``jdbc:…`` URLs (credentials from ``POSTGRES_*`` for PostgreSQL),
whose tables are in the schemas ``--core-schema`` and ``--dm-schema``
and are read over ``--jdbc-partitions`` connections.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from shopmart.contracts import CORE, DM_ITEMS, DM_ORDERS, MARTS
from shopmart.operators import items_mart, reports
from shopmart.plans import pipeline
from shopmart.session import REQUIRED_CONF
from shopmart.sources.io import (JDBC_PARTITIONS, Target, jdbc_target_from_env, pushed_table,
                                 read_table, write_table)
from shopmart.sources.load import clean, refresh_views


def target(spec: str, schema: str | None = None) -> Target:
    if spec.startswith("table:"):
        return Target.table(spec[len("table:"):])
    if spec.startswith("jdbc:postgresql:"):
        env_target = jdbc_target_from_env()
        return Target.jdbc(spec, schema=schema, **env_target.options)
    if spec.startswith("jdbc:"):
        return Target.jdbc(spec, schema=schema)
    return Target.parquet(spec)


def session(app: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    spark = builder.getOrCreate()
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) is None:     # the cluster's own setting wins
            spark.conf.set(key, value)
    return spark


def show_tables(spark: SparkSession, source: Target, schemas: dict) -> None:
    """Session views of a target's tables, so that SQL text finds them by name."""
    if source.kind == "parquet":
        refresh_views(spark, source, schemas)
    else:
        for name in schemas:
            read_table(spark, source, name).createOrReplaceTempView(name)


def print_rows(df: DataFrame) -> int:
    for row in df.toLocalIterator():
        print(json.dumps(row.asDict(), default=str))
    return 0


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="shopmart")
    sub = ap.add_subparsers(dest="command", required=True)
    p = sub.add_parser("extract")
    p.add_argument("--raw", required=True)
    p.add_argument("--stage", required=True)
    p = sub.add_parser("etl")
    p.add_argument("--stage", required=True)
    p.add_argument("--core", required=True)
    p.add_argument("--violations")
    p.add_argument("--fail-on-violation", action="store_true")
    p = sub.add_parser("load")
    p.add_argument("--core", required=True)
    p.add_argument("--to", required=True)
    p = sub.add_parser("marts")
    p.add_argument("--core", required=True)
    p.add_argument("--dm", required=True)
    p.add_argument("--partition-by-month", action="store_true")
    p.add_argument("--iso-year", action="store_true", help="weekly ranks by the ISO year")
    p.add_argument("--method", choices=sorted(items_mart.RANK_METHODS), default="sized")
    p.add_argument("--views", metavar="DATABASE")
    p = sub.add_parser("report")
    p.add_argument("name", choices=sorted(reports.REPORTS))
    p.add_argument("--dm", required=True)
    p.add_argument("--out")
    p = sub.add_parser("sql")
    p.add_argument("statement")
    p.add_argument("--dm")
    p.add_argument("--core")
    p = sub.add_parser("clean")
    p.add_argument("target")
    p.add_argument("--keep", type=int, default=1)
    p.add_argument("--grace-hours", type=float, default=24)
    for command in sub.choices.values():
        command.add_argument("--core-schema", default="core")
        command.add_argument("--dm-schema", default="dm")
        command.add_argument("--jdbc-partitions", type=int, default=JDBC_PARTITIONS)
    args = ap.parse_args(argv)

    spark = session(f"shopmart-{args.command}")
    if args.command == "extract":
        res = pipeline.run_extract(spark, args.raw, target(args.stage))
        out = {"rows": res.rows}
    elif args.command == "etl":
        vt = target(args.violations) if args.violations else None
        try:
            res = pipeline.run_etl(spark, target(args.stage), target(args.core, args.core_schema),
                                   violations_target=vt, jdbc_partitions=args.jdbc_partitions,
                                   fail_on_violation=args.fail_on_violation)
        except pipeline.ConstraintViolation as broken:
            print(json.dumps({"violations": broken.counts}))
            return 1
        out = {"rows": res.rows, "written": res.written}
    elif args.command == "load":
        res = pipeline.run_load(spark, target(args.core, args.core_schema),
                                target(args.to, args.core_schema), args.jdbc_partitions)
        out = {"rows": res.rows, "written": res.written}
    elif args.command == "marts":
        part = ["report_year", "report_month"] if args.partition_by_month else None
        res = pipeline.run_marts(spark, target(args.core, args.core_schema),
                                 target(args.dm, args.dm_schema), partition_by=part,
                                 jdbc_partitions=args.jdbc_partitions, views=args.views,
                                 iso_year=args.iso_year, method=args.method)
        out = {"rows": res.rows, "written": res.written}
    elif args.command == "clean":
        out = {"removed": clean(spark, target(args.target), args.keep, args.grace_hours)}
    elif args.command == "sql":
        for spec, contracts in ((args.core, CORE), (args.dm, MARTS)):
            if spec:
                show_tables(spark, target(spec), {n: c.schema for n, c in contracts.items()})
        return print_rows(spark.sql(args.statement))
    else:
        dm = target(args.dm, args.dm_schema)
        source, fn = reports.REPORTS[args.name]
        schema = DM_ORDERS.schema if source == "dm_orders" else DM_ITEMS.schema
        result = fn(pushed_table(spark, dm, source) if dm.kind == "jdbc" else
                    read_table(spark, dm, source, schema=schema))
        if args.out:
            out = {"written": write_table(result, target(args.out), args.name)}
        else:
            return print_rows(result)
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
