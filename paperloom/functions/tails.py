"""Normal and chi-square tails as column expressions.

Each is a sum or fraction over a sequence whose length is fixed or grows with the square root of the degrees
of freedom. Relative errors are below 1e-12 up to some thousand degrees of freedom.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bounds a p-value is clamped to before its normal deviate is taken.
P_LOW, P_HIGH = 1e-300, 1 - 1e-12

# Coefficients of Wichura's algorithm AS 241 for the normal quantile (numerator and
# denominator near the middle, in the tail, far in the tail), constant terms first.
AS_241 = (
    ((3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
      4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
     (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
      2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3)),
    ((1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
      1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
     (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
      1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9)),
    ((6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
      2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
     (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
      7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15)),
)
#: Where the tail goes from its series to its continued fraction, and the terms of each.
SWITCH, SERIES, FRACTION = 2.5, 40, 60


def _down(n: int) -> Column:
    return F.sequence(F.lit(n), F.lit(1), F.lit(-1))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def two_sided_p(z: Column | str) -> Column:
    """P(|normal| > |z|); NULL for NULL and NaN."""

    def tail(z: Column) -> Column:
        density = F.exp(z * z / -2.0) * (2 / math.sqrt(2 * math.pi))
        # z + z^3/3 + z^5/15 + ..., from the last term
        series = z * (1 + F.aggregate(_down(SERIES), F.lit(0.0), lambda s, k: (1 + s) * z * z / (2 * k + 1)))
        fraction = F.aggregate(_down(FRACTION), z, lambda f, k: z + k / f)
        return F.when(z < SWITCH, F.greatest(F.lit(0.0), 1 - density * series)).when(~F.isnan(z), density / fraction)

    return let(F.abs(F.col(z) if isinstance(z, str) else z), tail)


def _ratio(coefficients, x: Column) -> Column:
    numerator, denominator = (F.aggregate(F.array(*[F.lit(v) for v in reversed(c)]), F.lit(0.0), lambda s, v: s * x + v) for c in coefficients)
    return numerator / denominator


def deviate_of_p(p: Column) -> Column:
    """|z| that has the two-sided p-value ``p``, clamped to the bounds above; NULL for NULL and NaN."""

    def deviate(half: Column) -> Column:
        middle = F.lit(0.5) - half
        near = let(0.180625 - middle * middle, lambda x: middle * _ratio(AS_241[0], x))
        far = let(F.sqrt(-F.log(half)), lambda t: F.when(t <= 5.0, _ratio(AS_241[1], t - 1.6)).otherwise(_ratio(AS_241[2], t - 5.0)))
        return F.when(F.abs(middle) <= 0.425, near).otherwise(far)

    given = F.when(F.isnan(p), None).otherwise(p)
    return F.when(given.isNotNull(), let(F.least(F.greatest(given, F.lit(P_LOW)), F.lit(P_HIGH)) / 2.0, deviate))


def log_gamma(a: Column) -> Column:
    """For a > 0: Stirling's series sixteen steps up, and the product of the steps."""
    up = a + 16.0
    steps = a
    for i in range(1, 16):
        steps = steps * (a + float(i))
    square = 1.0 / (up * up)
    series = (1.0 / 12 - square * (1.0 / 360 - square * (1.0 / 1260 - square / 1680.0))) / up
    return (up - 0.5) * F.log(up) - up + 0.5 * math.log(2 * math.pi) + series - F.log(steps)


def chi2_tail(q: Column, df: Column) -> Column:
    """P(chi-square with ``df`` degrees of freedom > ``q``) for whole ``df``; NULL where ``df`` is 0 or anything is NULL."""

    def tail(given: Column) -> Column:
        a, x = given["a"], given["x"]
        # Terms fall off like a normal density whose spread is the square root of a.
        steps = F.sequence(F.lit(1), (F.ceil(F.sqrt(a) * 10.0) + 60).cast("int"))
        start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

        def total(factor) -> Column:
            def add(s: Column, j: Column) -> Column:
                return let(s["term"] * factor(j.cast("double")), lambda term: F.struct(term.alias("term"), (s["total"] + term).alias("total")))

            return F.aggregate(steps, start, add, lambda s: s["total"])

        # Below the mean the lower tail is summed upwards, above it the upper tail downwards, where the sum is finite:
        # it ends before a - j falls below 1, and for odd df the normal tail is left.
        lower = F.exp(a * F.log(x) - x - log_gamma(a + 1.0)) * total(lambda j: x / (a + j))
        finite = F.exp((a - 1.0) * F.log(x) - x - log_gamma(a)) * total(lambda j: F.when(a - j >= 1.0, (a - j) / x).otherwise(0.0))
        odd = (a * 2.0) % 2.0 == 1.0
        upper = F.when(odd, two_sided_p(F.sqrt(x * 2.0)) + F.when(a > 1.0, finite).otherwise(0.0)).otherwise(finite)
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.when(x <= 0, 1.0).when(x < a, 1.0 - lower).otherwise(upper)))

    q, df = q.cast("double"), df.cast("double")
    halves = F.struct((df / 2.0).alias("a"), (q / 2.0).alias("x"))
    return F.when((df > 0) & q.isNotNull() & ~F.isnan(q), let(halves, tail))
