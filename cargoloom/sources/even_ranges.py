"""Ranges of a whole-number key with about as many rows each, however its values lie.

Ranges of equal width leave most of them empty where the key has a gap, and one of them with nearly all rows where its values crowd. Here the
source counts rows per cell of the key, coarse cells first; cells with too many rows are counted again in finer ones, and
neighbouring cells are put together until a range is full. Counting is the source's work: one grouped query a round, over the cells still
too full. A round cuts each of them by ``SPLIT``, or by a power of it while a round has no more cells than ``FEW_CELLS``. So
the driver holds so many numbers, or some dozens per range.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Cells that a cell is cut into; a cell may hold this part of a range, so that ranges fill up.
SPLIT, FEW_CELLS, CELLS_PER_RANGE = 16, 1 << 16, 4

#: ``(width, coarser width, starts of the coarser cells to look into)`` to ``(start of a cell, rows)`` of each cell with rows.
Count = Callable[[int, int | None, Sequence[int]], Iterable[tuple[int, int]]]


def cell_start(column: str, low: int, width: int) -> str:
    """SQL for the first value of the cell that a key lies in; no division, so it is exact in every dialect."""
    return f"{column} - MOD({column} - {low}, {width})"


def cells_relation(table: str, column: str, where: str | None, low: int, width: int, coarser: int | None, starts: Sequence[int]) -> str:
    """The rows per cell as a subquery for a database."""
    conditions = [f"{column} >= {low}", *([f"({where})"] if where else [])]
    if coarser is not None:
        conditions.append(f"{cell_start(column, low, coarser)} IN ({', '.join(map(str, starts))})")
    cell = cell_start(column, low, width)
    return f"(SELECT {cell} AS cell, COUNT(*) AS n FROM {table} WHERE {' AND '.join(conditions)} GROUP BY {cell}) cells"


def frame_cells(df: DataFrame, column: str, low: int) -> Count:
    """The same count over a frame."""

    def start(width: int):
        return F.col(column) - F.pmod(F.col(column) - F.lit(low), F.lit(width))

    def count(width: int, coarser: int | None, starts: Sequence[int]) -> list[tuple[int, int]]:
        rows = df.where(F.col(column) >= low)
        if coarser is not None:
            rows = rows.where(start(coarser).isin(*starts))
        return [tuple(r) for r in rows.groupBy(start(width).alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()]

    return count


def even_ranges(count: Count, low: int, high: int, most: int) -> list[tuple[int, int]]:
    """``(first key, rows)`` of ranges that cover every key from ``low`` to ``high``, each up to the next one's first key.

    A range has at most ``most`` rows, but where one key alone has more. With distinct keys the largest has at most twice the mean.
    """
    width = 1
    while (high - low) // width >= FEW_CELLS:
        width *= SPLIT
    fine: list[tuple[int, int]] = []
    coarser, crowded = None, []
    while True:
        found = [(int(start), int(n)) for start, n in count(width, coarser, crowded)]
        crowded = [start for start, n in found if n * CELLS_PER_RANGE > most and width > 1]
        again = set(crowded)
        fine += [(start, n) for start, n in found if start not in again]
        if not crowded:
            break
        coarser, width = width, width // SPLIT
        while width > 1 and coarser // width * SPLIT * len(crowded) <= FEW_CELLS:
            width //= SPLIT
    ranges: list[tuple[int, int]] = []
    for start, n in sorted(fine):
        if ranges and ranges[-1][1] + n <= most:
            ranges[-1] = (ranges[-1][0], ranges[-1][1] + n)
        else:
            ranges.append((start, n))
    return ranges


def range_predicates(column: str, starts: Sequence[int]) -> list[str]:
    """One condition per range. The first has no lower end and takes keys that are null, the last has no upper end, so together
    they hold every row, also those that came after the count."""
    if len(starts) < 2:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(starts[1:], starts[2:], strict=False)]
    return [f"{column} < {starts[1]} OR {column} IS NULL", *inner, f"{column} >= {starts[-1]}"]
