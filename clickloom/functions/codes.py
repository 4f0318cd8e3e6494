"""Codes, interval bins and pair keys."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickloom.functions.packed_time import whole


def province(region: Column) -> Column:
    """Province of a hundred-coded region."""
    return whole(region, 100).cast("int")


def category_level1(category: Column) -> Column:
    return whole(category, 100).cast("int")


def category_level2(category: Column) -> Column:
    return (category % 100).cast("int")


def pair_number(first: Column, second: Column) -> Column:
    """Szudzik's pairing: one whole number per pair of non-negative ids."""
    a, b = first.cast("long"), second.cast("long")
    return F.when(a >= b, a * a + a + b).otherwise(b * b + a)


def pair_text(first: Column, second: Column) -> Column:
    """``first-second`` as text; null when either part is null."""
    return F.concat(first.cast("string"), F.lit("-"), second.cast("string"))


def cut(value: Column, edges: Sequence[float], right: bool = True) -> Column:
    """Integer bin code of ``value`` among ascending ``edges``.

    ``right=True``: bins ``(e[i], e[i+1]]`` with the very first edge included.
    ``right=False``: bins ``[e[i], e[i+1])`` with the very last edge excluded.
    Outside all bins, or null, gives null.
    """
    if list(edges) != sorted(set(edges)) or len(edges) < 2:
        raise ValueError("edges must be ascending and at least two")
    inside = value >= edges[0]
    code = F.lit(None).cast("int")
    for number in reversed(range(len(edges) - 1)):
        upper = edges[number + 1]
        below = value <= upper if right else value < upper
        code = F.when(below, F.lit(number)).otherwise(code)
    return F.when(inside, code)


def log_spaced(first_power: float, last_power: float, count: int, ceil: bool = False) -> list[float]:
    """``count`` edges from ``10**first_power`` to ``10**last_power``, evenly spaced in the exponent."""
    gap = (last_power - first_power) / (count - 1)
    edges = [10 ** (first_power + gap * i) for i in range(count)]
    return [float(math.ceil(round(e, 9))) for e in edges] if ceil else edges


def same_known_or_unknown(left: Column, right: Column) -> Column:
    """True when both codes are equal; a null on either side counts as different."""
    return F.coalesce(left == right, F.lit(False))
