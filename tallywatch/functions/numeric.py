"""Numeric expressions: truthy averages, bands, softmax, tail probabilities."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def settle(value: Column, digits: int = 6) -> Column:
    """Round half up with a little slack, so that sums added in another order round alike."""
    scale = 10.0**digits
    return (F.floor(value * F.lit(scale) + F.lit(0.500001)) / F.lit(scale)).cast("double")


def truthy(value: Column) -> Column:
    """NULL for NULL and 0, the value otherwise."""
    return F.nullif(value, F.lit(0).cast("double"))


def share(part: Column, whole: Column) -> Column:
    """Part of a whole as DOUBLE; NULL when the whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def band(value: Column, edges: Sequence[float], names: Sequence[str], inclusive_upper: bool = False) -> Column:
    """Name the interval a value falls in: `names[i]` below `edges[i]` (or up to it), the last name above all."""
    chain = None
    for edge, name in zip(edges, names):
        hit = value <= edge if inclusive_upper else value < edge
        chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    return F.when(value.isNotNull(), chain.otherwise(names[-1]))


def softmax(logits: Column) -> Column:
    """Softmax of an array, shifted by its maximum."""
    top = F.array_max(logits)
    exps = F.transform(logits, lambda z: F.exp(z - top))
    total = F.aggregate(exps, F.lit(0.0), lambda acc, e: acc + e)
    return F.transform(exps, lambda e: e / total)


def argmax(values: Column) -> Column:
    """0-based position of the largest value, the lowest position on ties."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def kolmogorov_p(distance: Column, n_ref: Column, n_cur: Column, terms: int = 100) -> Column:
    """Two-sided p-value of the two-sample Kolmogorov-Smirnov distance from the limiting series."""
    effective = n_ref.cast("double") * n_cur / (n_ref + n_cur)
    lam = F.sqrt(effective) * distance
    steps = F.sequence(F.lit(1), F.lit(terms))
    series = F.aggregate(
        steps,
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * lam * lam),
    )
    return F.when(lam < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


# Coefficients of the Lanczos series for the gamma function with g = 7.
LANCZOS = (
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059, 12.507343278686905,
    -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7,
)
TINY = 1e-300


def log_gamma(z: Column) -> Column:
    """Natural logarithm of the gamma function for z >= 0.5."""
    x = z.cast("double") - 1.0
    total = F.lit(LANCZOS[0])
    for k, c in enumerate(LANCZOS[1:], 1):
        total = total + F.lit(c) / (x + float(k))
    t = x + 7.5
    return 0.5 * math.log(2 * math.pi) + (x + 0.5) * F.log(t) - t + F.log(total)


def _steps(size: Column) -> Column:
    """As many steps as series and fractions of this size need for full precision."""
    return F.sequence(F.lit(1), (60 + 10 * F.sqrt(size)).cast("int"))


def _away_from_zero(x: Column) -> Column:
    return F.when(F.abs(x) < TINY, TINY).otherwise(x)


def gamma_q(a: Column, x: Column) -> Column:
    """Regularised upper incomplete gamma function: a power series below a + 1, a continued fraction above."""
    a, x = a.cast("double"), x.cast("double")
    safe = F.greatest(x, F.lit(TINY))
    front = F.exp(-safe + a * F.log(safe) - log_gamma(a))
    start = F.struct((1.0 / a).alias("term"), (1.0 / a).alias("total"))

    def add(acc: Column, k: Column) -> Column:
        term = acc["term"] * safe / (a + k)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    series = 1.0 - front * F.aggregate(_steps(a), start, add, lambda acc: acc["total"])
    first = 1.0 / _away_from_zero(safe + 1.0 - a)
    begin = F.struct(F.lit(1 / TINY).alias("c"), first.alias("d"), first.alias("h"))

    def extend(acc: Column, k: Column) -> Column:
        part, b = -k * (k - a), safe + 1.0 - a + 2.0 * k
        d = 1.0 / _away_from_zero(part * acc["d"] + b)
        c = _away_from_zero(b + part / acc["c"])
        return F.struct(c.alias("c"), d.alias("d"), (acc["h"] * d * c).alias("h"))

    fraction = front * F.aggregate(_steps(a), begin, extend, lambda acc: acc["h"])
    return F.when(x <= 0, 1.0).otherwise(F.greatest(F.lit(0.0), F.when(x < a + 1.0, series).otherwise(fraction)))


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    first = 1.0 / _away_from_zero(1.0 - (a + b) * x / (a + 1.0))
    begin = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))

    def extend(acc: Column, k: Column) -> Column:
        even = k * (b - k) * x / ((a + 2.0 * k - 1.0) * (a + 2.0 * k))
        d1 = 1.0 / _away_from_zero(1.0 + even * acc["d"])
        c1 = _away_from_zero(1.0 + even / acc["c"])
        odd = -(a + k) * (a + b + k) * x / ((a + 2.0 * k) * (a + 2.0 * k + 1.0))
        d = 1.0 / _away_from_zero(1.0 + odd * d1)
        c = _away_from_zero(1.0 + odd / c1)
        return F.struct(c.alias("c"), d.alias("d"), (acc["h"] * d1 * c1 * d * c).alias("h"))

    return F.aggregate(_steps(F.greatest(a, b)), begin, extend, lambda acc: acc["h"])


def beta_i(a: Column, b: Column, x: Column) -> Column:
    """Regularised incomplete beta function by its continued fraction, taken from the side where that is short."""
    a, b, x = a.cast("double"), b.cast("double"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), x.cast("double")))
    inside = F.greatest(F.lit(TINY), F.least(F.lit(1.0 - 1e-16), x))
    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(inside) + b * F.log1p(-inside))
    low = inside < (a + 1.0) / (a + b + 2.0)
    found = F.when(low, front * _beta_fraction(a, b, inside) / a).otherwise(1.0 - front * _beta_fraction(b, a, 1.0 - inside) / b)
    return F.when(x <= 0, 0.0).when(x >= 1, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), found)))


def normal_p(z: Column) -> Column:
    """Two-sided p-value of a standard normal `z`."""
    return gamma_q(F.lit(0.5), z * z / 2.0)


def chi_square_p(statistic: Column, df: Column) -> Column:
    """p-value of a chi-square statistic; 1 without degrees of freedom."""
    return F.when(df < 1, 1.0).otherwise(gamma_q(F.greatest(df, F.lit(1)) / 2.0, statistic / 2.0))


def student_t_p(r: Column, n: Column) -> Column:
    """Two-sided p-value of a correlation `r` over `n` points; 1 below three points, for NULL and for no correlation."""
    df = (n - 2).cast("double")
    p = beta_i(F.greatest(df, F.lit(1.0)) / 2.0, F.lit(0.5), 1.0 - r * r)
    return F.when((df < 1) | r.isNull(), 1.0).when(F.abs(r) >= 1.0 - 1e-15, 0.0).otherwise(p)


def kolmogorov_exact(distance: float, n_ref: int, n_cur: int) -> float:
    """Exact two-sided p-value of the two-sample distance of untied samples: the share of lattice paths that leave the band.

    A path's steps are taken by anti-diagonals with probabilities instead of counts, so nothing overflows; the work grows with
    (n_ref + n_cur) times the width of the band.
    """
    if not n_ref or not n_cur:
        return 1.0
    limit = round(distance * n_ref * n_cur)  # distances are whole multiples of 1 / (n_ref * n_cur)
    if limit <= 0:
        return 1.0
    few, many = sorted((n_ref, n_cur))
    i = np.arange(few + 1)
    inside = np.zeros(few + 1)
    inside[0] = 1.0
    for s in range(1, few + many + 1):
        low = max(0, s - many, -((limit - 1 - s * few) // (few + many)))  # |i * many - (s - i) * few| < limit
        high = min(few, s, (limit - 1 + s * few) // (few + many))
        new = np.zeros(few + 1)
        if low <= high:
            own = slice(low, high + 1)
            new[own] = inside[own] * (s - i[own]) / s
            before = slice(max(low, 1) - 1, high)
            new[max(low, 1) : high + 1] += inside[before] * i[max(low, 1) : high + 1] / s
        inside = new
    return float(min(1.0, max(0.0, 1.0 - inside[few])))


def kolmogorov_small_p(distance: Column, n_ref: Column, n_cur: Column, exact_cells: int = 4_000_000) -> Column:
    """The exact p-value where n_ref * n_cur is at most `exact_cells`, the limiting series beyond.

    The series is for large samples; at the default bound (2,000 of each) it differs from the exact value by less than 0.02.
    """

    @F.pandas_udf("double")
    def exact(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        small = [x is not None and x == x and a * b <= exact_cells for x, a, b in zip(d, n, m)]
        return pd.Series([kolmogorov_exact(float(x), int(a), int(b)) if s else None for s, x, a, b in zip(small, d, n, m)], dtype="float64")

    return F.coalesce(exact(distance, n_ref.cast("long"), n_cur.cast("long")), kolmogorov_p(distance, n_ref, n_cur))


def jensen_shannon(ref: Column, cur: Column) -> Column:
    """One category's part of the Jensen-Shannon divergence (natural log) between two shares."""
    mid = (ref + cur) / 2
    part_ref = F.when(ref > 0, ref * F.log(ref / mid)).otherwise(0.0)
    part_cur = F.when(cur > 0, cur * F.log(cur / mid)).otherwise(0.0)
    return (part_ref + part_cur) / 2


def stability_index(ref: Column, cur: Column, floor: float = 1e-4) -> Column:
    """One category's part of the population stability index; empty shares count as `floor`."""
    safe_ref, safe_cur = F.greatest(ref, F.lit(floor)), F.greatest(cur, F.lit(floor))
    return (safe_cur - safe_ref) * F.log(safe_cur / safe_ref)
