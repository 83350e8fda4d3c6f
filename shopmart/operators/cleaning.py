"""Generic cleaning operators: null defaults, required columns, key
de-duplication, dense surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopmart.operators.ranges import plan_cells

# Columns the load step fills with 0 before splitting the raw table.
RAW_ZERO_DEFAULTS = ("item_discount", "order_discount", "delivery_cost", "item_canceled_quantity")


def fill_defaults(raw: DataFrame, columns: Sequence[str] = RAW_ZERO_DEFAULTS) -> DataFrame:
    """NULL → 0 in ``columns``, keeping each column's type (K1).

    Implemented as ``coalesce(c, 0)`` in one projection; a float column also
    has NaN replaced, as ``fillna`` would.
    """
    types = dict(raw.dtypes)
    fills = {}
    for c in columns:
        col = F.col(c)
        if types[c] in ("double", "float"):
            col = F.nanvl(col, F.lit(0.0))
        fills[c] = F.coalesce(col, F.lit(0).cast(types[c]))
    return raw.withColumns(fills)


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with NULL (or NaN) in any of ``columns``; NOT NULL reaches the scan."""
    types = dict(df.dtypes)
    for c in columns:
        df = df.filter(F.col(c).isNotNull())
        if types[c] in ("double", "float"):
            df = df.filter(~F.isnan(c))
    return df


def dedupe_by_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per ``key``: the row whose remaining columns are greatest.

    ``max(struct(...))`` is combined on the map side, so a hot key costs one
    row per map task; its buffer is not fixed-width, so Spark sorts the rows of
    a map task by key first.  The survivor does not depend on partitioning or
    arrival order.
    """
    key = list(key)
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.distinct()
    return (df.groupBy(*key)
            .agg(F.max(F.struct(*rest)).alias("_row"))
            .select(*key, *[F.col("_row")[c].alias(c) for c in rest]))


CELL_ROWS = 1 << 16  # rows of a cell that one task numbers


def with_surrogate_key(df: DataFrame, name: str, order_cols: Sequence[str],
                       after: int = 0, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Add a dense key in ``order_cols`` order (NULLs first) from ``after`` + 1, as a sequence would.

    Equal rows are counted first (map-side), so copies are one row until the
    end.  The others are dealt to cells of about ``cell_rows`` rows that ascend with the first two order
    columns, for ids of any spread (``ranges.plan_cells``).  Cells are numbered
    inside, and start at the sum of all cells before them, added up level by level, so no window
    holds more than a cell's rows or the at most 65,537 cells within a cell.  Cells follow from the values
    and their counts, so the key does not depend on layout or retries, and nothing is written.
    ``order_cols`` must cover the columns that tell rows apart.
    """
    order_cols = list(order_cols)
    rest = [c for c in df.columns if c not in order_cols]
    rows = df.groupBy(*order_cols, *rest).agg(F.count(F.lit(1)).alias("_copies"))
    planned = plan_cells(df, order_cols[0], order_cols[min(1, len(order_cols) - 1)], cell_rows)
    rows, cells = planned.add(rows), planned.names
    before = (Window.unboundedPreceding, -1)
    sums, starts = rows.groupBy(*cells).agg(F.sum("_copies").alias("_n")), None
    for i in range(len(cells), 0, -1):
        # The rows of a cell's earlier siblings, from the sums of the level.
        level = sums if i == len(cells) else sums.groupBy(*cells[:i]).agg(F.sum("_n").alias("_n"))
        siblings = Window.partitionBy(*cells[:i - 1]).orderBy(cells[i - 1]).rowsBetween(*before)
        level = level.select(*cells[:i], F.coalesce(F.sum("_n").over(siblings), F.lit(0)).alias(f"_s{i}"))
        starts = level if starts is None else starts.join(level, cells[:i])
    starts = starts.select(*cells, sum((F.col(f"_s{i}") for i in range(1, len(cells) + 1)),
                                       F.lit(0)).alias("_start"))
    within = (Window.partitionBy(*cells).orderBy(*[F.col(c).asc_nulls_first() for c in [*order_cols, *rest]])
              .rowsBetween(*before))
    numbered = (rows.withColumn("_before", F.coalesce(F.sum("_copies").over(within), F.lit(0)))
                .join(starts, cells))
    lowest = F.col("_start") + F.col("_before") + 1 + after
    return (numbered.withColumn(name, F.explode(
        F.sequence(lowest, lowest + F.col("_copies") - 1))).select(*df.columns, name))
