"""Special functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The first coefficients of Stirling's series for the logarithm of the gamma function.
STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360)
_SHIFT = 8


def log_gamma(a: Column) -> Column:
    """ln of the gamma function of a positive number, to about 12 digits."""
    z = a + _SHIFT
    series, product = F.lit(0.0), F.lit(1.0)
    for k, c in enumerate(STIRLING):
        series = series + F.lit(c) / F.pow(z, F.lit(2 * k + 1))
    for k in range(_SHIFT):
        product = product * (a + k)
    half_log_two_pi = 0.9189385332046727
    return (z - 0.5) * F.log(z) - z + half_log_two_pi + series - F.log(product)


def upper_gamma(a: Column, z: Column) -> Column:
    """The regularised upper incomplete gamma function of positive numbers, whole-row JVM code.

    Below a + 1 the power series of the lower function, above it the continued fraction of the
    upper one, evaluated from its end. Both take about ten times the square root of ``a`` terms.
    """
    terms = (F.lit(60) + F.lit(10) * F.ceil(F.sqrt(a))).cast("int")
    front = F.exp(a * F.log(z) - z - log_gamma(a))
    state = F.struct((F.lit(1.0) / a).alias("term"), (F.lit(1.0) / a).alias("total"))

    def add(s: Column, n: Column) -> Column:
        term = s["term"] * z / (a + n)
        return F.struct(term.alias("term"), (s["total"] + term).alias("total"))

    lower = front * F.aggregate(F.sequence(F.lit(1), terms), state, add, lambda s: s["total"])
    steps = F.sequence(terms, F.lit(1), F.lit(-1))
    fraction = F.aggregate(
        steps,
        z + F.lit(2.0) * terms + 1.0 - a,
        lambda h, i: z + F.lit(2.0) * i - 1.0 - a - i * (i - a) / h,
    )
    return F.when(z < a + 1, F.greatest(F.lit(0.0), F.lit(1.0) - lower)).otherwise(F.least(F.lit(1.0), front / fraction))


def chi_square_tail(x: Column, dof: Column) -> Column:
    """P(chi-square with ``dof`` degrees of freedom > x); 1 without a degree of freedom or for x
    up to 0; NULL for a NULL."""
    a, z = dof.cast("double") / 2, x.cast("double") / 2
    some = F.when((dof > 0) & (x > 0), upper_gamma(a, z)).otherwise(F.lit(1.0))
    return F.when(x.isNotNull() & dof.isNotNull(), some)
