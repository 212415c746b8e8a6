"""Distribution functions as native column expressions (no Python per row).

``normal_cdf`` is Hart's double-precision rational approximation of the standard normal CDF (as published by West,
"Better approximations to cumulative normal functions", 2005): absolute error about 1e-16. ``normal_cdf_sql``
writes the same arithmetic for the DuckDB oracle, so both engines evaluate the same formula.

``chi2_sf`` is the chi-square upper tail, the regularized upper incomplete gamma ``Q(k/2, x/2)``: a power series
below ``a + 1`` and a Lentz continued fraction above, or a uniform asymptotic form where the shape is large.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of the Hart / West algorithm (numerator and denominator, highest power first).
NUMERATOR = [3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871,
             221.213596169931, 220.206867912376]
DENOMINATOR = [8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674,
               637.333633378831, 793.826512519948, 440.413735824752]
SPLIT = 7.07106781186547
CUTOFF = 37.0
SQRT_2PI = 2.506628274631
TAIL_TERMS = [0.65, 4.0, 3.0, 2.0, 1.0]


def _horner(xa, coefs, lit):
    acc = lit(coefs[0])
    for c in coefs[1:]:
        acc = acc * xa + lit(c)
    return acc


def normal_cdf(x: Column) -> Column:
    """Standard normal CDF of ``x`` (NULL stays NULL)."""
    xa = F.abs(x)
    e = F.exp(-xa * xa / F.lit(2.0))
    central = e * _horner(xa, NUMERATOR, F.lit) / _horner(xa, DENOMINATOR, F.lit)
    b = xa + F.lit(TAIL_TERMS[0])
    for t in TAIL_TERMS[1:]:
        b = xa + F.lit(t) / b
    tail = e / b / F.lit(SQRT_2PI)
    lower = F.when(xa > CUTOFF, F.lit(0.0)).when(xa < SPLIT, central).otherwise(tail)
    return F.when(x > 0, F.lit(1.0) - lower).otherwise(lower)


def normal_cdf_sql(x: str) -> str:
    """The same function as DuckDB SQL over the expression ``x``."""
    xa = f"abs({x})"

    def horner(coefs):
        acc = repr(coefs[0])
        for c in coefs[1:]:
            acc = f"({acc} * {xa} + {c!r})"
        return acc

    e = f"exp(-{xa} * {xa} / 2.0)"
    central = f"({e} * {horner(NUMERATOR)} / {horner(DENOMINATOR)})"
    b = f"({xa} + {TAIL_TERMS[0]!r})"
    for t in TAIL_TERMS[1:]:
        b = f"({xa} + {t!r} / {b})"
    tail = f"({e} / {b} / {SQRT_2PI!r})"
    lower = f"(CASE WHEN {xa} > {CUTOFF!r} THEN 0.0 WHEN {xa} < {SPLIT!r} THEN {central} ELSE {tail} END)"
    return f"(CASE WHEN {x} > 0 THEN 1.0 - {lower} ELSE {lower} END)"


#: Terms of the series and the continued fraction below ``UNIFORM_FROM``. Both need about 6 sqrt(2 a) terms at worst (at
#: z close to the shape a), fewer than 200 there, so that they have converged in any case.
GAMMA_TERMS = 400
UNIFORM_FROM = 400.0
TINY = 1e-300

# Coefficients of the Stirling series of ln Gamma (powers 1/x, 1/x^3, ...), and of the functions c0, c1, c2
# of the uniform asymptotic form in powers of eta (Temme 1979; NIST DLMF 8.12).
STIRLING = [1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188]
TEMME = [
    [-1 / 3, 1 / 12, -2 / 135, 1 / 864, 1 / 2835, -139 / 777600, 1 / 25515, -571 / 261273600],
    [-1 / 540, -1 / 288, 1 / 378, -77 / 77760, 1 / 4860],
    [25 / 6048, -139 / 51840, 101 / 136080],
]


def log_gamma(x: Column) -> Column:
    """``ln Gamma(x)`` for ``x > 0`` at constant cost: Stirling's series at ``x + 10``, then ten steps down."""
    y = x + F.lit(10.0)
    product = x
    for k in range(1, 10):
        product = product * (x + F.lit(float(k)))
    r = F.lit(1.0) / (y * y)
    series = F.lit(STIRLING[-1])
    for c in reversed(STIRLING[:-1]):
        series = series * r + F.lit(c)
    return (y - 0.5) * F.log(y) - y + F.lit(0.5 * math.log(2 * math.pi)) + series / y - F.log(product)


def _power_series(x: Column, coefs) -> Column:
    acc = F.lit(coefs[-1])
    for c in reversed(coefs[:-1]):
        acc = acc * x + F.lit(c)
    return acc


def _upper_gamma_uniform(a: Column, z: Column) -> Column:
    """``Q(a, z)`` for large ``a``: ``Phi(-eta sqrt(a))`` plus a correction, at the same cost for every ``a`` and ``z``.

    ``eta^2 / 2 = m - ln(1 + m)`` with ``m = z / a - 1`` and the sign of ``m``. The correction's series in ``eta`` is
    used where it matters, ``|eta| <= 1``; beyond, both tails are below 1e-80 for these ``a``.
    """
    m = (z - a) / a
    half = F.greatest(m - F.log1p(m), F.lit(0.0))
    eta = F.signum(m) * F.sqrt(half * 2)
    near = F.least(F.greatest(eta, F.lit(-1.0)), F.lit(1.0))
    series = sum((_power_series(near, c) / F.pow(a, F.lit(float(k))) for k, c in enumerate(TEMME)), F.lit(0.0))
    rest = F.exp(-a * half) / F.sqrt(a * F.lit(2 * math.pi)) * series
    return F.least(F.greatest(normal_cdf(-eta * F.sqrt(a)) + rest, F.lit(0.0)), F.lit(1.0))


def chi2_sf(x: Column, dof: Column, terms: int = GAMMA_TERMS) -> Column:
    """``P(X > x)`` for ``X ~ chi-square(dof)`` at any ``dof``; 1 for ``x <= 0``, NULL for ``dof <= 0`` or NULL inputs.

    Up to ``UNIFORM_FROM`` the power series (below the shape) or the continued fraction (above it), beyond it the
    uniform asymptotic form; all of them are accurate to about 1e-10 where they are used.
    """
    a = dof.cast("double") / 2
    z = x.cast("double") / 2
    small = F.least(a, F.lit(UNIFORM_FROM))  # keeps the branch that isn't taken finite
    lg_a1 = log_gamma(small + 1)
    seq = F.sequence(F.lit(1), F.lit(terms))
    # Series for P(a, z): sum_{n>=0} z^n / ((a+1)...(a+n)), then Q = 1 - P.
    zs = F.least(z, small + 1)
    series = F.aggregate(
        seq, F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s")),
        lambda st, n: F.struct((st["t"] * zs / (small + n)).alias("t"), (st["s"] + st["t"] * zs / (small + n)).alias("s")),
        lambda st: st["s"])
    lower = F.exp(-z + small * F.log(z) - lg_a1) * series
    q_series = F.greatest(F.lit(0.0), F.lit(1.0) - lower)

    # Continued fraction for Q(a, z) (modified Lentz).
    def step(st, i):
        an = -(i.cast("double")) * (i.cast("double") - small)
        b = st["b"] + 2.0
        d0 = an * st["d"] + b
        d1 = F.when(F.abs(d0) < TINY, F.lit(TINY)).otherwise(d0)
        c0 = b + an / st["c"]
        c1 = F.when(F.abs(c0) < TINY, F.lit(TINY)).otherwise(c0)
        d2 = F.lit(1.0) / d1
        return F.struct(b.alias("b"), c1.alias("c"), d2.alias("d"), (st["h"] * d2 * c1).alias("h"))

    b0 = z + 1.0 - small
    # b0 > 0 wherever this branch is chosen (z >= a + 1); try_divide keeps the unused branch from raising.
    start = F.struct(b0.alias("b"), F.lit(1.0 / TINY).alias("c"), F.try_divide(F.lit(1.0), b0).alias("d"),
                     F.try_divide(F.lit(1.0), b0).alias("h"))
    fraction = F.aggregate(seq, start, step, lambda st: st["h"])
    lg_a = lg_a1 - F.log(small)
    q_fraction = F.least(F.lit(1.0), F.exp(-z + small * F.log(z) - lg_a) * fraction)
    return F.when(x.isNull() | dof.isNull() | (dof <= 0), F.lit(None).cast("double")) \
        .when(x <= 0, F.lit(1.0)).when(a > UNIFORM_FROM, _upper_gamma_uniform(a, z)) \
        .when(z < a + 1, q_series).otherwise(q_fraction)
