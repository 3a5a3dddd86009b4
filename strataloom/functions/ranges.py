"""Ranges of an ordered column."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column
from pyspark.sql import functions as F


def range_of(value: Column, bounds: list) -> Column:
    """How many of the sorted bounds are at most the value.

    A search in two steps, through the first bound of each block and then through one block, so a row meets about twice the
    square root of their number.
    """
    if not bounds:
        return F.lit(0)
    step = isqrt(len(bounds))
    blocks = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    among = lambda some: F.array_size(F.filter(some, lambda c: c <= value))
    block = among(F.array(*[F.lit(b[0]) for b in blocks]))
    inside = among(F.element_at(F.array(*[F.array(*[F.lit(c) for c in b]) for b in blocks]), F.greatest(block, F.lit(1))))
    return F.when(block == 0, 0).otherwise((block - 1) * step + inside)
