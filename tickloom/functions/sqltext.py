"""Expressions as SQL text, for wide projections.

A projection of hundreds of columns costs seconds when every operator of every column is
a call into the JVM; as text each column is one.  Catalyst sees the same plan.
"""

from __future__ import annotations


def q(name: str) -> str:
    """Quoted identifier; names may start with a digit."""
    return f"`{name}`"


def ratio(num: str, den: str) -> str:
    """Floating division that is null on a zero divisor."""
    return f"CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0D)"


def rows(n: int | None, partition: str = "symbol_id", order: str = "date") -> str:
    """Window over the current row and the ``n - 1`` before it (all before it for None)."""
    start = "UNBOUNDED" if n is None else str(n - 1)
    return f"(PARTITION BY {partition} ORDER BY {order} ROWS BETWEEN {start} PRECEDING AND CURRENT ROW)"


def to_units(x: str, scale: int) -> str:
    """``x`` as a whole number of ``10**-scale`` units."""
    return f"CAST(rint({x} * {10**scale}D) AS BIGINT)"


def from_units(units: str, scale: int) -> str:
    return f"CAST({units} AS DOUBLE) / {10**scale}D"


def adjusted(g1: str, n: str) -> str:
    """Sample-adjusted skewness (G1) from the population form and the count."""
    return f"CASE WHEN {n} >= 3 THEN {g1} * sqrt({n} * ({n} - 1)) / nullif({n} - 2, 0D) END"


def adjusted_skewness(x: str) -> str:
    """Aggregate form of G1: null below three values."""
    return adjusted(f"skewness({x})", f"CAST(count({x}) AS DOUBLE)")
