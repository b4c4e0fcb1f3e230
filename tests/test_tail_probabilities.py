"""Tail probabilities against published tables and plain sums."""

from __future__ import annotations

import math
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tallywatch.functions import numeric


def values(spark, *columns):
    return list(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


def test_chi_square_and_normal_tables(spark):
    # upper points of the chi-square distribution (df, point, p) and of the normal distribution
    table = [(1, 3.841459, 0.05), (2, 5.991465, 0.05), (10, 18.307038, 0.05), (30, 50.892181, 0.01), (100, 124.342113, 0.05), (5, 0.831212, 0.975)]
    assert values(spark, *[numeric.chi_square_p(F.lit(x), F.lit(df)) for df, x, _ in table]) == pytest.approx([p for *_, p in table], abs=1e-6)
    even = [(2 * k, x) for k in (1, 3, 400) for x in (0.5, 7.0, 700.0, 900.0)]  # closed form for whole halves
    want = [math.fsum(math.exp(-x / 2 + j * math.log(x / 2) - math.lgamma(j + 1)) for j in range(df // 2)) for df, x in even]
    assert values(spark, *[numeric.chi_square_p(F.lit(x), F.lit(df)) for df, x in even]) == pytest.approx(want, abs=1e-9)
    z = [0.0, 0.5, 1.959964, 3.0, 6.0]
    assert values(spark, *[numeric.normal_p(F.lit(x)) for x in z]) == pytest.approx([math.erfc(x / math.sqrt(2)) for x in z], rel=1e-9)
    assert values(spark, numeric.chi_square_p(F.lit(0.0), F.lit(3)), numeric.chi_square_p(F.lit(5.0), F.lit(0))) == [1.0, 1.0]


def test_student_is_one_formula_for_all_sizes(spark):
    def p(r, n):
        """By the integral of the density, cut finely."""
        df, t = n - 2, abs(r) * math.sqrt((n - 2) / (1 - r * r))
        c = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi)
        k = 20_000
        f = [c * (1 + (t * i / k) ** 2 / df) ** (-(df + 1) / 2) for i in range(k + 1)]
        return 1 - 2 * t / k / 3 * (f[0] + f[-1] + 4 * sum(f[1::2]) + 2 * sum(f[2:-1:2]))

    cases = [(0.1, 5), (0.9, 4), (0.05, 9_999), (0.05, 10_001), (0.05, 10_003), (0.01, 100_000), (-0.6, 12)]
    assert values(spark, *[numeric.student_t_p(F.lit(r), F.lit(n)) for r, n in cases]) == pytest.approx([p(r, n) for r, n in cases], abs=1e-9)


def plain_ks(d, n, m):
    """Share of all orders of n and m untied values whose distance is at least d."""
    hits = total = 0
    for own in combinations(range(n + m), n):
        chosen, i, j, far = set(own), 0, 0, 0.0
        for k in range(n + m):
            i, j = i + (k in chosen), j + (k not in chosen)
            far = max(far, abs(i / n - j / m))
        total, hits = total + 1, hits + (far >= d - 1e-12)
    return hits / total


def test_exact_distance_probabilities():
    for n, m in ((1, 1), (3, 4), (5, 5), (2, 7), (6, 4)):
        for k in range(n * m + 1):
            assert numeric.kolmogorov_exact(k / (n * m), n, m) == pytest.approx(plain_ks(k / (n * m), n, m), abs=1e-12)
    # critical values of the two-sample table for equal sizes at 5 %: 10 -> 7/10, 20 -> 9/20, 30 -> 11/30 (first below)
    for n, k in ((10, 7), (20, 9), (30, 11)):
        assert numeric.kolmogorov_exact(k / n, n, n) < 0.05 < numeric.kolmogorov_exact((k - 1) / n, n, n)
    assert numeric.kolmogorov_exact(0.3, 0, 5) == 1.0 == numeric.kolmogorov_exact(0.0, 4, 5)


def test_large_samples_take_the_series(spark):
    d, n = F.lit(0.1), F.lit(3000)
    exact, series, mixed, none = values(
        spark, F.lit(numeric.kolmogorov_exact(0.1, 300, 300)), numeric.kolmogorov_p(d, n, n), numeric.kolmogorov_small_p(d, F.lit(300), F.lit(300)),
        numeric.kolmogorov_small_p(d, n, n),
    )
    assert mixed == pytest.approx(exact) and none == series and abs(exact - values(spark, numeric.kolmogorov_p(d, F.lit(300), F.lit(300)))[0]) < 0.02
