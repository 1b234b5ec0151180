"""Column expressions for the library's one total order.

Every ranking in the package orders rows by ``(score DESC, id ASC)``; ids are
unique, so this is a total order and equal scores are broken the same way on
every run and every partitioning.  Ids may have any type that Spark can order
(integers, text, binary, dates, ...).  The helpers below compare rows against
literal points of that order; bucket numbers of scores come from Spark ML's
``Bucketizer`` (a JVM binary search per row - a large ``CASE WHEN`` tree
would switch whole-stage codegen off), those of ids inside a giant tie from
:func:`splits_at_or_before`, see
:func:`caprank.operators.ranking.assign_buckets`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def point_precedes(point: tuple[float, object], score: Column, rid: Column) -> Column:
    """True when the literal point comes strictly before the row."""
    ps, pid = point
    return (score < F.lit(float(ps))) | ((score == F.lit(float(ps))) & (rid > F.lit(pid)))


def row_at_or_before(point: tuple[float, object], score: Column, rid: Column) -> Column:
    """True when the row is at or before the literal point (inside a top set)."""
    return ~point_precedes(point, score, rid)


def sort_key(row_score: float, row_id) -> tuple[float, object]:
    """Python sort key matching the library order."""
    return (-row_score, row_id)


FAN = 16


def splits_at_or_before(value: Column, splits: list) -> Column:
    """Number of the ascending literals ``splits`` that are <= ``value``, by a
    search tree laid out as array literals: about ``FAN`` comparisons a level in
    the type of the value itself, so no id is rounded to a double."""
    size = FAN
    while size <= len(splits):
        size *= FAN
    found = F.lit(0)  # the answer, rounded down to the size of a block
    while size > 1:
        step = size // FAN
        # the answer lies in the j-th child or later if split lo + j * step - 1 is <= value
        blocks = [[splits[i] for i in range(lo + step - 1, min(lo + size, len(splits)), step)] or [None]
                  for lo in range(0, len(splits) + 1, size)]
        arrays = [F.array(*[F.lit(x) for x in b]) for b in blocks]
        own = arrays[0] if len(arrays) == 1 else F.element_at(F.array(*arrays), F.floor(found / size).cast("int") + 1)
        found = found + F.lit(step) * F.size(F.filter(own, lambda x: x <= value))
        size = step
    return found
