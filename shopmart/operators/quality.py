"""Data-quality checks as distributed jobs.

The database enforced NOT NULL, primary keys, UNIQUE, foreign keys and
CHECK rules row by row on insert; here each family is one DataFrame that
lists the violations, so a load can be gated on them or the offending rows
written aside.  All checks are aggregates or anti-joins — no row ever
reaches the driver.  ``count_violations`` counts all checks of all tables in one job that scans
each table once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmart.contracts import CHECKS, Contract


def check_not_null(df: DataFrame, contract: Contract) -> DataFrame:
    """(table_name, column_name, null_rows) for every required column.

    One pass: a single aggregate of ``count_if(c IS NULL)`` per column,
    then unpivoted to one row per column.
    """
    cols = list(contract.required)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return (counts.unpivot([], cols, "column_name", "null_rows")
            .select(F.lit(contract.name).alias("table_name"), "column_name", "null_rows"))


def check_unique(df: DataFrame, key: Sequence[str], allow_null: bool = False) -> DataFrame:
    """Key values held by more than one row, or (for a primary key) with a NULL part.

    Returns the key columns and ``n_rows``.  ``count`` is mergeable, so a
    hot key is pre-counted on the map side before the shuffle.
    """
    key = list(key)
    bad = F.col("n_rows") > 1
    if not allow_null:
        bad = bad | reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter(bad)


def check_foreign_key(child: DataFrame, column: str, parent: DataFrame,
                      parent_key: str) -> DataFrame:
    """Child rows whose non-NULL reference has no parent row.

    A left-anti join on the reference; NULL references pass, as in SQL.
    Spark broadcasts the parent keys when they are measured small and
    otherwise shuffles both sides, splitting a hot reference (AQE skew join;
    the parent keys are not made distinct, as an aggregate above their
    exchange would keep AQE from splitting).
    """
    keys = parent.select(F.col(parent_key).alias("_parent_key"))
    return (child.filter(F.col(column).isNotNull())
            .join(keys, F.col(column) == F.col("_parent_key"), "left_anti"))


def violates(rule: Column) -> Column:
    """A CHECK fails only when its rule is FALSE; UNKNOWN passes."""
    return ~F.coalesce(rule, F.lit(True))


def check_predicate(df: DataFrame, name: str, rule: Column) -> DataFrame:
    """Rows violating one CHECK rule, tagged with its name."""
    return df.filter(violates(rule)).select(F.lit(name).alias("check_name"), *df.columns)


def check_rules(df: DataFrame, table: str) -> DataFrame:
    """Rows violating any CHECK rule of ``table``, one row per (rule, row).

    Evaluated in one scan: each rule becomes a flag, the failing rule names
    are collected per row and exploded.
    """
    rules = CHECKS[table]
    failed = F.filter(F.array(*[F.when(violates(rule()), F.lit(name)) for name, rule in rules]),
                      lambda x: x.isNotNull())
    return (df.withColumn("_failed", failed)
            .filter(F.size("_failed") > 0)
            .select(F.explode("_failed").alias("check_name"), *df.columns))


_WHOLE = ("bigint", "int", "smallint", "tinyint")


def _key_columns(df: DataFrame, key: Sequence[str]) -> list[Column]:
    """(k1, k2, text) that are equal for equal keys only: numbers, or a text for other keys."""
    types = dict(df.dtypes)
    if len(key) <= 2 and all(types[c] in _WHOLE for c in key):
        parts = [F.col(c).cast("bigint") for c in key]
        return [*parts, *[F.lit(None).cast("bigint")] * (2 - len(parts)), F.lit(None).cast("string")]
    text = F.to_json(F.array(*(F.col(c).cast("string") for c in key)), {"ignoreNullFields": "false"})
    return [F.lit(None).cast("bigint")] * 2 + [text]


def _types(df: DataFrame, columns: Sequence[str]) -> list[str]:
    types = dict(df.dtypes)
    return [types[c] for c in columns]


class _Domains:
    """Numbers of the keys that checks look at, and of the references to each."""

    def __init__(self, contracts: dict[str, Contract], foreign_keys: Sequence, rule_tables: Sequence[str]):
        self.counted = [f"not_null_{n}" for n in contracts] + [f"checks_{n}" for n in rule_tables]
        self.keys = [(n, key) for n, c in contracts.items() for key in (c.key, *c.unique)]
        self.slots, per_key = {}, {}
        for fk in foreign_keys:
            domain = self.number(fk.parent, (fk.parent_key,))
            per_key[domain] = per_key.get(domain, -1) + 1
            self.slots[fk.name] = (domain, per_key[domain])
        self.width = max(per_key.values(), default=-1) + 1

    def number(self, table: str, key: Sequence[str]) -> int:
        return self.keys.index((table, tuple(key)))


OWN, NULL_PART, FIRST_REFERENCE = 0, 1, 2


def _facts(df: DataFrame, contract: Contract, foreign_keys: Sequence, domains: _Domains) -> DataFrame:
    """(domain, k1, k2, text, slot, n): what one scan of a table says to the checks.

    A domain is a key of some table; the table's own rows come under slot ``OWN``, those with a null in a primary
    key under ``NULL_PART``, references under a slot each.  Counts of broken NOT NULL and CHECK rules come
    under domain -1, by the check's number.
    """
    def fact(domain: int, key: Sequence[Column], slot, n: Column | None = None) -> Column:
        values = [F.lit(domain), *key, F.lit(slot) if isinstance(slot, int) else slot,
                  F.lit(1) if n is None else n.cast("int")]
        return F.struct(*(v.alias(a) for v, a in zip(values, ("domain", "k1", "k2", "text", "slot", "n"))))

    def count(check: str, n: Column) -> Column:
        nothing = F.lit(None).cast("bigint")
        key = [F.lit(domains.counted.index(check)).cast("bigint"), nothing, F.lit(None).cast("string")]
        return F.when(n > 0, fact(-1, key, OWN, n))

    facts = [count(f"not_null_{contract.name}",
                   sum((F.col(c).isNull().cast("int") for c in contract.required), F.lit(0)))]
    if f"checks_{contract.name}" in domains.counted:
        facts.append(count(f"checks_{contract.name}",
                           sum((violates(rule()).cast("int") for _, rule in CHECKS[contract.name]), F.lit(0))))
    null_part = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in contract.key])
    for key in (contract.key, *contract.unique):
        slot = F.when(null_part, F.lit(NULL_PART)).otherwise(F.lit(OWN)) if key == contract.key else OWN
        facts.append(fact(domains.number(contract.name, key), _key_columns(df, key), slot))
    for fk in foreign_keys:
        if fk.child == contract.name:
            domain, slot = domains.slots[fk.name]
            facts.append(F.when(F.col(fk.column).isNotNull(), fact(
                domain, _key_columns(df, [fk.column]), FIRST_REFERENCE + slot)))
    return (df.select(F.explode(F.array(*facts)).alias("fact")).where(F.col("fact").isNotNull())
            .select("fact.*"))


def count_violations(tables: dict[str, DataFrame], contracts: dict[str, Contract],
                     foreign_keys: Sequence, rule_tables: Sequence[str]) -> DataFrame:
    """(check_name, violations) of every check, as many as the single checks have rows.

    NOT NULL counts nulls, the other checks rows.  Each table is scanned once: its keys, its references and its
    broken rules go as tagged rows into one aggregation, combined on the map side and exchanged once, so
    neither a hot reference nor a repeated key gathers rows in a task.
    """
    domains, facts = _Domains(contracts, foreign_keys, rule_tables), None
    for name, contract in contracts.items():
        own = _facts(tables[name], contract, foreign_keys, domains)
        facts = own if facts is None else facts.unionByName(own)
    slots = [f"s{i}" for i in range(FIRST_REFERENCE + domains.width)]
    # A text key is rare; without one the groups are of numbers alone.
    texts = [c for c in ("text",) if any(len(k) > 2 or any(t not in _WHOLE for t in _types(tables[n], k))
                                         for n, k in domains.keys)]
    met = facts.groupBy("domain", "k1", "k2", *texts).agg(
        *(F.sum(F.when(F.col("slot") == i, F.col("n")).otherwise(0)).alias(s) for i, s in enumerate(slots)))
    here, totals = F.col("domain"), []
    for i, (name, key) in enumerate(domains.keys):
        check = f"unique_{name}" + ("" if key == contracts[name].key else f"_{'_'.join(key)}")
        totals.append(F.count_if((here == i) & ((F.col("s0") > 1) | (F.col("s1") > 0))).alias(check))
    for fk, (domain, slot) in domains.slots.items():
        orphans = (here == domain) & (F.col("s0") == 0) & (F.col("s1") == 0)
        totals.append(F.sum(F.when(orphans, F.col(slots[FIRST_REFERENCE + slot])).otherwise(0)).alias(fk))
    totals += [F.sum(F.when((here == -1) & (F.col("k1") == i), F.col("s0")).otherwise(0)).alias(check)
               for i, check in enumerate(domains.counted)]
    row = met.agg(*totals)  # one row of counts
    return row.select(*(F.coalesce(F.col(c), F.lit(0)).alias(c) for c in row.columns)).unpivot(
        [], row.columns, "check_name", "violations")
