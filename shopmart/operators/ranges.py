"""Order-preserving cells of a column, as many as the rows call for, whatever the values' spread.

Sorting or ranking a large table in parts needs ranges of equal size.  Cells of a fixed width suit
dense ids only: hashed 64-bit ids would each get a cell of their own.  Here a group's smallest and
largest value and its number of rows (one mergeable aggregate, so a hot group is combined on the map
side) say how wide a cell is: ids spread evenly, dense or hashed, fill cells of about
``cell_rows`` rows.  Where values crowd, a second step cuts the crowded cells by their own bounds.

Cells follow from values and exact counts alone, never from samples: a stage that is computed again
after a lost executor puts every row in the same cell.

``with_cell`` does one step inside the plan, for groups of any number.  ``plan_cells`` asks the data first
and takes as many steps as it needs, for one ordered table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_CELLS = 1 << 16  # cells of a group in one step
FINE = 1 << 12        # least cells that a crowded cell is cut into
MOST_STEPS = 12       # 64-bit values part in five steps, two such columns in ten
TEXT_BYTES = 24       # leading bytes of a string that steps can tell apart


def positions(column: str, dtype: str) -> list[Column]:
    """Doubles that together rise with the column: a later one counts where all earlier ones are equal.

    Long integers and strings take several, as a double holds 53 bits; nulls stay null.
    """
    c = F.col(column)
    if dtype == "string":
        parts = []
        for at in range(0, TEXT_BYTES, 6):  # a missing byte counts as zero, so a prefix comes first
            leading = F.hex(F.substring(c.cast("binary"), at + 1, 6))
            parts.append(F.conv(F.rpad(F.when(leading == "", "0").otherwise(leading), 12, "0"), 16, 10)
                         .cast("double"))
        return parts
    if dtype == "bigint":
        return [F.shiftright(c, 11).cast("double"), c.bitwiseAND(F.lit(2047)).cast("double")]
    if dtype == "date":
        return [F.unix_date(c).cast("double")]
    if dtype in ("timestamp", "timestamp_ntz"):
        return [F.unix_micros(c.cast("timestamp")).cast("double")]
    return [c.cast("double")]


def with_cell(df: DataFrame, name: str, by: Sequence[str], column: str, cell_rows: int) -> DataFrame:
    """``df`` and the cell ``name`` of ``column`` within each group of ``by``.

    Cells are numbered from 0 in the column's order, -1 holds its nulls; equal values share a cell
    (strings: by their first bytes).
    Groups of at most ``cell_rows`` rows have one cell.  Group columns are joined null-safe.
    """
    by, dtype = list(by), dict(df.dtypes)[column]
    c = F.col(column)
    at = positions(column, dtype)[0] if dtype == "string" else (
        c.cast("double") if dtype == "bigint" else positions(column, dtype)[0])
    stats = df.groupBy(*by).agg(F.min(at).alias("_low"), F.max(at).alias("_high"),
                                F.count(F.lit(1)).alias("_rows"))
    stats = stats.select(*(F.col(c).alias(f"_by{i}") for i, c in enumerate(by)), "_low", "_high",
                         F.least(F.ceil(F.col("_rows") / cell_rows), F.lit(MOST_CELLS)).alias("_cells"))
    same = F.lit(True)
    for i, group in enumerate(by):
        same = same & F.col(group).eqNullSafe(F.col(f"_by{i}"))
    joined, (low, high, cells) = df.join(stats, same), map(F.col, ("_low", "_high", "_cells"))
    cell = _cell(at, low, high, cells)
    return joined.select(*df.columns, cell.alias(name))


@dataclass
class Cells:
    """Rules found by ``plan_cells``: ``add`` gives rows their cells.

    ``first`` is (lowest, highest, cells) of all rows; each later step is a table with a row for every
    crowded cell: its path so far, which position to cut by, lowest, highest and cells.
    """

    positions: list[Column]
    first: tuple[float, float, int]
    steps: list[DataFrame]

    @property
    def names(self) -> list[str]:
        return [f"_cell{i}" for i in range(len(self.steps) + 1)]

    def add(self, df: DataFrame) -> DataFrame:
        low, high, cells = (F.lit(v) for v in self.first)
        df = df.withColumn("_cell0", _cell(self.positions[0], low, high, cells))
        for i, rules in enumerate(self.steps, 1):
            at = F.coalesce(*(F.when(F.col("_by") == k, p) for k, p in enumerate(self.positions)))
            cell = F.when(F.col("_cells").isNull(), F.lit(0).cast("long")).otherwise(
                _cell(at, F.col("_low"), F.col("_high"), F.col("_cells")))
            df = (df.join(rules, self.names[:i], "left").withColumn(f"_cell{i}", cell)
                  .drop("_by", "_low", "_high", "_cells"))
        return df


def _cell(at: Column, low: Column, high: Column, cells: Column) -> Column:
    """The cell of a position between two bounds; -1 for a null."""
    share = (at - low) / F.nullif(high - low, F.lit(0.0))
    inside = F.least(F.floor(share * cells).cast("long"), cells.cast("long") - 1)
    return F.when(at.isNull(), F.lit(-1)).otherwise(F.coalesce(inside, F.lit(0))).cast("long")


def plan_cells(df: DataFrame, first: str, second: str, cell_rows: int) -> Cells:
    """Cells of about ``cell_rows`` rows that ascend with (``first``, ``second``), nulls first.

    One job finds the bounds, and each further one the cells that are still crowded: usually none.  A crowded
    cell is cut by ``first`` while it holds several of its values, then by ``second``.  Jobs scan the two
    columns alone and write nothing; a row per crowded cell comes to the driver, at most rows / ``cell_rows``.
    What cannot be told apart by these columns (strings by their first 24 bytes) stays one cell.
    """
    types = dict(df.dtypes)
    own = positions(first, types[first])
    ways = own + (positions(second, types[second]) if second != first else [])
    bounds = df.agg(F.min(ways[0]), F.max(ways[0]), F.count(F.lit(1))).first()
    low, high = (0.0 if b is None else b for b in bounds[:2])
    found = Cells(ways, (low, high, min(MOST_CELLS, max(1, -(-bounds[2] // cell_rows)))), [])
    limits = [f(p).alias(f"{name}{i}") for i, p in enumerate(ways) for name, f in (("low", F.min), ("high", F.max))]
    while len(found.steps) < MOST_STEPS and bounds[2] > cell_rows:
        crowded = (found.add(df.select(*dict.fromkeys((first, second)))).groupBy(*found.names)
                   .agg(F.count(F.lit(1)).alias("n"), F.min(first).eqNullSafe(F.max(first)).alias("single"), *limits)
                   .where(F.col("n") > 2 * cell_rows).collect())
        rules = []
        for cell in crowded:
            way = _next_way(cell, len(own), len(ways))
            if way is not None:
                cells = min(MOST_CELLS, max(FINE, 4 * -(-cell.n // cell_rows)))
                rules.append((*(cell[c] for c in found.names), way, cell[f"low{way}"], cell[f"high{way}"], cells))
        if not rules:
            break
        path = ", ".join(f"{c} long" for c in found.names)
        found.steps.append(df.sparkSession.createDataFrame(
            rules, f"{path}, _by int, _low double, _high double, _cells long"))
    return found


def _next_way(cell, own: int, ways: int) -> int | None:
    """The first position that still parts a crowded cell's rows, if cutting there keeps the order."""
    for way in range(ways):
        if way == own and not cell["single"]:
            return None  # several first values that no position tells apart
        if cell[f"low{way}"] is not None and cell[f"low{way}"] < cell[f"high{way}"]:
            return way
    return None
