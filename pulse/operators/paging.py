"""Deep pages by seeking: a histogram of the sort key finds the range that holds a page.

``offset(start)`` keeps start + length rows in every task. Here one pass counts the rows per range of the first sort
column (split points from a sample of its values, each split point a range of its own), then only the range that holds
row ``start`` is counted again, finer or by the next column, until it holds few rows. The page is a top-k over that
range and, if it ends within the page, the ranges behind it. The ranges are predicates on plain columns, so they are
pushed into scans. Any sample gives the same page; it only decides how fast the ranges shrink.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPLITS = 64          # split points of a histogram: at most 2 * SPLITS + 2 counts reach the driver
FEW_ROWS = 10_000    # a range of so many rows is not split any more
MOST_PASSES = 40


def _literal(value, df: DataFrame, col: str) -> Column:
    return F.lit(value).cast(df.schema[col].dataType)


def histogram(rows: DataFrame, col: str, descending: bool) -> list[tuple[Column, int, bool]]:
    """(predicate, rows, whether all its rows have the same value) of the ranges of ``col`` that hold
    rows, in sort order: nulls first, or last if descending."""
    c = F.col(col)
    found = rows.where(c.isNotNull()).select(c.alias("v")).orderBy(F.xxhash64("v", F.rand(1))).limit(SPLITS).collect()
    values = sorted({r["v"] for r in found if r["v"] == r["v"]})  # NaN sorts behind all of them
    points = F.array(*[_literal(v, rows, col) for v in values]) if values else None
    if points is None:
        place = F.lit(-1)
    else:
        below = F.size(F.filter(points, lambda v: v < c))
        place = F.when(c.isNull(), F.lit(-1)).otherwise(2 * below + F.when(F.array_contains(points, c), 1).otherwise(0))
    counts = {r["place"]: r["n"] for r in rows.groupBy(place.alias("place")).agg(F.count(F.lit(1)).alias("n")).collect()}

    def predicate(k: int) -> Column:
        if k < 0:
            return c.isNull()
        i = k // 2
        if k % 2:
            return c == _literal(values[i], rows, col)
        above, under = (c > _literal(values[i - 1], rows, col)) if i else None, (c < _literal(values[i], rows, col)) if i < len(values) else None
        return above & under if above is not None and under is not None else c.isNotNull() if above is None and under is None else above if under is None else under

    return [(predicate(k), counts[k], k < 0 or k % 2 == 1) for k in sorted(counts, reverse=descending)]


def seek(rows: DataFrame, order: Sequence[tuple[str, bool]], start: int, length: int, few: int = FEW_ROWS) -> tuple[Column, int, int]:
    """(predicate, offset, total): the rows ``start+1 .. start+length`` of the total ``order`` (column,
    descending) are the rows ``offset+1 .. offset+length`` of those that meet the predicate."""
    inside, behind, column, left, total = F.lit(True), [], 0, start, None
    for _ in range(MOST_PASSES):
        name, descending = order[column]
        ranges = histogram(rows.where(inside), name, descending)
        if total is None:
            total = sum(n for _, n, _ in ranges)
            if start >= total:
                return F.lit(False), 0, total
        at = 0
        while left >= ranges[at][1]:
            left -= ranges[at][1]
            at += 1
        predicate, n, same = ranges[at]
        behind = [(inside & p, m) for p, m, _ in ranges[at + 1:]] + behind
        inside = inside & predicate
        column += same
        if n <= few or column == len(order):
            break
    held = n - left
    for p, m in behind:  # the page goes on behind the range
        if held >= length:
            break
        inside, held = inside | p, held + m
    return inside, left, total
