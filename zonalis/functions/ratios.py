"""Ratio, index and binning expressions over count columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonalis.functions import fixed_values as V


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pct(num: str | Column, den: str | Column, scale: float = 100.0) -> Column:
    """num/den scaled; 0 where the denominator is not positive."""
    d = _c(den)
    return F.when(d > 0, _c(num) / d * scale).otherwise(F.lit(0.0))


def row_sum(cols: Sequence[str | Column]) -> Column:
    total = F.lit(0)
    for c in cols:
        total = total + F.coalesce(_c(c), F.lit(0))
    return total


def mean_of_available(parts: Sequence[Column], default: float | None = None) -> Column:
    """Mean of the non-null parts."""
    n = row_sum([p.isNotNull().cast("int") for p in parts])
    return F.when(n > 0, row_sum(parts) / n).otherwise(F.lit(default).cast("double"))


def weighted_of_available(parts: Sequence[tuple[Column, float]]) -> Column:
    """Σ w·x / Σ w over the parts that are present; null when none is."""
    top = row_sum([p * w for p, w in parts])
    low = row_sum([F.when(p.isNotNull(), w) for p, w in parts])
    return F.when(low > 0, top / low)


def mean_age_deviation(columns: Sequence[str], national: float = V.NATIONAL_MEDIAN_AGE) -> Column:
    known = [c for c in V.AGE_MIDPOINTS if c in columns]
    people = row_sum(known)
    years = row_sum([_c(c) * V.AGE_MIDPOINTS[c] for c in known])
    return F.when(people > 0, years / people).otherwise(0.0) - national


def simpson(cols: Sequence[str | Column]) -> Column:
    total = row_sum(cols)
    squares = row_sum([F.pow(_c(c) / total, F.lit(2)) for c in cols])
    return F.when(total > 0, F.lit(1.0) - squares).otherwise(0.0)


def shannon(cols: Sequence[str | Column]) -> Column:
    """Entropy of the shares over that of equal shares."""
    total = row_sum(cols)
    terms = [F.when(_c(c) > 0, (_c(c) / total) * F.ln(_c(c) / total)) for c in cols]
    spread = -row_sum(terms) / F.ln(F.lit(float(len(cols))))
    return F.when(total > 0, spread).otherwise(0.0) if len(cols) > 1 else F.lit(0.0)


def skill_imbalance(cols: Sequence[str | Column]) -> Column:
    """Coefficient of variation (population) of the positive counts, in %, at most 100."""
    xs = F.filter(F.array(*[_c(c).cast("double") for c in cols]), lambda x: x > 0)
    n = F.size(xs)
    total = F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)
    mean = total / n
    var = F.aggregate(xs, F.lit(0.0), lambda a, x: a + F.pow(x - mean, F.lit(2))) / n
    return F.when(n < 2, 0.0).otherwise(F.least(F.sqrt(var) / mean * 100, F.lit(100.0)))


def average_vehicles(one: str, two: str, three_plus: str, known: Column) -> Column:
    return pct(_c(one) + _c(two) * 2 + _c(three_plus) * 3.5, known, 1.0)


def monthly_rent(weekly: Column) -> Column:
    return weekly * 4.33


def positive_or_null(c: Column) -> Column:
    return F.when(c > 0, c)


def affordability(ratio: Column) -> Column:
    return (
        F.when(ratio.isNull(), "Unknown")
        .when(ratio > 0.7, "Low Purchase Affordability")
        .when(ratio > 0.5, "Moderate Purchase Affordability")
        .otherwise("High Purchase Affordability")
    )


# Right-closed edges and labels of payment ranges.
MORTGAGE_RANGES = [(1500, "Under $1,500"), (2500, "$1,500-$2,500"), (3500, "$2,500-$3,500"),
                   (5000, "$3,500-$5,000"), (float("inf"), "Over $5,000")]
RENT_RANGES = [(300, "Under $300"), (500, "$300-$500"), (700, "$500-$700"),
               (1000, "$700-$1,000"), (float("inf"), "Over $1,000")]


def right_closed_bin(c: Column, ranges: Sequence[tuple[float, str]], lowest: float = 0.0) -> Column:
    out = F.when(c < lowest, None)
    for edge, label in ranges:
        out = out.when(c <= edge, label)
    return out


def normalise(c: Column, low: float, high: float, *, inverse: bool = False, as_coded: bool = False) -> Column:
    """0-100 position within [low, high].  Reversed bounds with `as_coded` invert twice."""
    lo, hi = min(low, high), max(low, high)
    clipped = F.least(F.greatest(c, F.lit(float(lo))), F.lit(float(hi)))
    if low == high:
        return F.lit(50.0)
    if as_coded:
        out = (clipped - low) / (high - low) * 100
    else:
        out = (clipped - lo) / (hi - lo) * 100
    out = 100 - out if inverse else out
    return F.when(c.isNotNull(), out)


def age_standardised_rate(rates: dict[str, Column], standard: dict[str, float] | None = None) -> Column:
    """Σ rate·standard / Σ standard over bands with a rate."""
    standard = standard or V.STANDARD_POPULATION
    return weighted_of_available([(r, float(standard[b])) for b, r in rates.items() if b in standard])


def age_specific_rates(overall: Column, populations: dict[str, Column]) -> dict[str, Column]:
    return {
        b: F.when(p > 0, overall * V.AGE_RATE_MULTIPLIER.get(b, 1.0)) for b, p in populations.items()
    }


def heat_index(t: Column, h: Column) -> Column:
    # Published polynomial coefficients, applied from 27 degrees up.
    poly = (
        -42.379 + 2.04901523 * t + 10.14333127 * h - 0.22475541 * t * h - 6.83783e-3 * t * t
        - 5.481717e-2 * h * h + 1.22874e-3 * t * t * h + 8.5282e-4 * t * h * h - 1.99e-6 * t * t * h * h
    )
    return F.when((t >= 27) & h.isNotNull(), poly)


def aridity(rain: Column, daily_evaporation: Column) -> Column:
    return F.when(daily_evaporation > 0, rain / (daily_evaporation * 30))


def compactness(area: Column, perimeter: Column) -> Column:
    return F.when(perimeter > 0, 4 * F.pi() * area / (perimeter * perimeter)).otherwise(0.0)
