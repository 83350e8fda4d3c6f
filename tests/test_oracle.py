"""Every registered query equals its DuckDB oracle (rows, columns, values)."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from shopmart.plans.columns import COLUMNS
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem".split()
SPARK_TO_DUCK = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float) and math.isnan(v):
            return "nan"
        return repr(v)
    return sorted("|".join(norm(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    # The document operators are tested against brute force where SQL cannot express them.
    assert set(COLUMNS) <= set(queries()) and set(COLUMNS) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())


def test_each_family_of_checks_finds_something(spark):
    found = {n for n in COLUMNS if n.startswith("check_") and not queries()[n](spark, SF_SMALL).isEmpty()}
    assert {"check_not_null_marts", "check_unique_raw_order_item", "check_unique_order_items_line",
            "check_unique_dm_orders_day_city", "check_fk_orders_store_with_city",
            "check_fk_order_drivers_delivered", "check_rules_order_items"} <= found


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == COLUMNS["q1_weekday_totals"]
    assert df.count() == 7


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    assert df.columns == COLUMNS[name], "plans/columns.py is out of date"
    rel = duck.execute(oracle_sql()[name])
    d_cols = [d[0] for d in rel.description]
    assert sorted(d_cols) == sorted(df.columns)
    # Same engine-neutral types on both sides, column by column.
    spark_types = {f.name: SPARK_TO_DUCK[f.dataType.simpleString()] for f in df.schema.fields}
    assert spark_types == {d[0]: str(d[1]) for d in rel.description}
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(d_cols, rel.fetchall())
