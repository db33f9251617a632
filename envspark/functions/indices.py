"""Column expressions for sub-indices, the overall index, categories and risk levels.

Everything here is a `CASE WHEN` or arithmetic expression, so it stays inside
whole-stage code generation and also works on streaming DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from envspark.profiles import (BEYOND_SCALE, CATEGORY_EDGES, POLLUTANTS, RISK_EDGES, RISK_FLOOR,
                               Profile, profile_of)


def segments(edges: tuple[Sequence[float], Sequence[float]]) -> list[tuple[float, float, float, float]]:
    """(c_lo, c_hi, i_lo, slope) of every linear piece of a breakpoint table."""
    conc, index = edges
    return [
        (float(c0), float(c1), float(i0), (i1 - i0) / (c1 - c0))
        for c0, c1, i0, i1 in zip(conc, conc[1:], index, index[1:])
    ]


def sub_index(pollutant: str, profile: str | Profile, column: str | None = None) -> Column:
    """Piecewise-linear index of one pollutant, upper edges inclusive.

    Written as SQL text: one expression to parse instead of a hundred small calls
    into the JVM per frame.
    """
    p = profile_of(profile)
    x = column or pollutant
    pieces = segments(p.bands[pollutant])
    cap = p.above_scale.get(pollutant)
    missing = p.missing_index.get(pollutant)

    branches = [f"WHEN {x} <= {c_hi!r}D THEN {i_lo!r}D + {slope!r}D * ({x} - {c_lo!r}D)"
                for c_lo, c_hi, i_lo, slope in (pieces if cap is not None else pieces[:-1])]
    c_lo, c_hi, i_lo, slope = pieces[-1]
    if cap is None:
        branches.append(f"WHEN {x} > {c_lo!r}D THEN {i_lo!r}D + {slope!r}D * ({x} - {c_lo!r}D)")
    else:
        branches.append(f"WHEN {x} > {c_hi!r}D THEN {cap!r}D")
    tail = "" if missing is None else f"ELSE {missing!r}D"
    return F.expr(f"CASE {' '.join(branches)} {tail} END")


def interpolate(column: Column, bands: Sequence[tuple[float, float, float, float]],
                beyond: float | None = BEYOND_SCALE) -> Column:
    """Index from any (c_lo, c_hi, i_lo, i_hi) table with closed bands.

    The first band that holds the value wins. Values in no band, those in the
    gaps of a gapped table included, become `beyond`; NULL stays NULL.
    """
    if not bands:
        raise ValueError("a breakpoint table needs at least one band")
    chain = F.when(column.isNull(), F.lit(None).cast("double"))
    for c_lo, c_hi, i_lo, i_hi in bands:
        slope = (i_hi - i_lo) / (c_hi - c_lo)
        chain = chain.when((column >= F.lit(float(c_lo))) & (column <= F.lit(float(c_hi))),
                           F.lit(slope) * (column - F.lit(float(c_lo))) + F.lit(float(i_lo)))
    return chain.otherwise(F.lit(beyond).cast("double"))


def overall_index() -> Column:
    """Largest sub-index; NULL sub-indices are skipped, NaN wins."""
    return F.greatest(*[F.col(f"aqi_{p}") for p in POLLUTANTS])


def category(column: Column) -> Column:
    """Health category of an index value. NULL falls through to the last label."""
    (first_label, first_edge), *rest = CATEGORY_EDGES
    chain = F.when(column <= F.lit(first_edge), F.lit(first_label))
    for label, edge in rest:
        chain = chain.otherwise(F.lit(label)) if edge is None else chain.when(
            column <= F.lit(edge), F.lit(label))
    return chain


def risk_level(column: Column) -> Column:
    """Risk label of an average index value. NULL falls through to the lowest label."""
    (first_label, first_edge), *rest = RISK_EDGES
    chain = F.when(column > F.lit(first_edge), F.lit(first_label))
    for label, edge in rest:
        chain = chain.when(column > F.lit(edge), F.lit(label))
    return chain.otherwise(F.lit(RISK_FLOOR))
