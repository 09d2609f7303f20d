"""Helpers for writing the DuckDB oracle text.

Spark averages a DECIMAL exactly: it divides the exact sum by the count
once, HALF_UP, at the result scale s+4.  DuckDB returns a double for the same expression, so the
oracle re-derives Spark's digits with integer arithmetic on scaled units.
"""

from __future__ import annotations


def _div_scale(p1: int, s1: int, p2: int = 20, s2: int = 0) -> int:
    scale = max(6, s1 + p2 + 1)
    prec = p1 - s1 + s2 + scale
    if prec > 38:
        int_digits = prec - scale
        scale = max(38 - int_digits, min(scale, 6))
    return scale


def half_up_div(num: str, den: str) -> str:
    return (f"(CASE WHEN ({num}) >= 0 THEN (2*({num}) + ({den})) // (2*({den})) "
            f"ELSE -((2*(-({num})) + ({den})) // (2*({den}))) END)")


def spark_avg_units(units_expr: str, p: int, s: int) -> tuple[str, int]:
    """Spark ``avg`` of a decimal(p, s) column given as integer units at scale s.

    Returns (aggregate SQL giving integer units at the result scale, result scale).
    """
    f = min(38, s + 4)
    k = f
    total = f"cast(sum({units_expr}) AS HUGEINT) * cast({10 ** (k - s)} AS HUGEINT)"
    r1 = half_up_div(total, f"count({units_expr})")
    if k > f:
        return half_up_div(r1, f"cast({10 ** (k - f)} AS HUGEINT)"), f
    return r1, k


def units(expr: str, s: int) -> str:
    """Integer units of a decimal expression with scale s."""
    return f"cast(({expr}) * {10 ** s} AS HUGEINT)"


def units_to_double(u: str, s: int) -> str:
    """Correctly rounded double of units * 10^-s (string parse, as Spark's decimal -> double)."""
    return f"cast(cast({u} AS VARCHAR) || 'e-{s}' AS DOUBLE)"
