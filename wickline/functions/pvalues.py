"""Two-sided tails of the normal and Student distributions as column expressions: series, continued fraction, finite sums."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Terms of the series below ``MEET``, and levels of the continued fraction above it.
TERMS, LEVELS, MEET = 80, 120, 3.0
#: Degrees of freedom up to which Student's tail is summed exactly; beyond, it is the normal tail of a transformed value.
EXACT_DF = 4000


def _column(x: Column | str) -> Column:
    return F.nanvl((F.col(x) if isinstance(x, str) else x).cast("double"), F.lit(None).cast("double"))


def normal_p(z: Column | str) -> Column:
    """P(|Z| >= |z|); null for null and NaN."""
    a = F.abs(_column(z))
    density = F.exp(-a * a / 2) / math.sqrt(2 * math.pi)
    small = F.least(a, F.lit(MEET))
    series = F.aggregate(
        F.sequence(F.lit(0), F.lit(TERMS - 1)), F.struct(F.lit(0.0).alias("total"), small.alias("term")),
        lambda s, n: F.struct((s["total"] + s["term"]).alias("total"), (s["term"] * small * small / (2 * n + 3)).alias("term")),
        lambda s: s["total"])
    large = F.greatest(a, F.lit(MEET))
    fraction = F.aggregate(F.sequence(F.lit(LEVELS), F.lit(1), F.lit(-1)), large, lambda f, n: large + n / f)
    return F.when(a < MEET, 1 - 2 * density * series).when(a.isNotNull(), 2 * density / fraction)


def student_p(t: Column | str, df: Column | str) -> Column:
    """P(|T| >= |t|) for whole degrees of freedom by the finite trigonometric sums; null for null, NaN, or no freedom."""
    a, n = F.abs(_column(t)), (F.col(df) if isinstance(df, str) else df).cast("bigint")
    theta = F.atan(a / F.sqrt(n.cast("double")))
    squared, odd = F.cos(theta) * F.cos(theta), (n % 2).cast("double")
    terms = F.least((n - n % 2) / 2, F.lit(EXACT_DF / 2)).cast("int")
    steps = F.when(terms > 0, F.sequence(F.lit(0), terms - 1)).otherwise(F.array().cast("array<int>"))
    total = F.aggregate(
        steps, F.struct(F.lit(0.0).alias("total"), F.lit(1.0).alias("term")),
        lambda s, j: F.struct((s["total"] + s["term"]).alias("total"),
                              (s["term"] * squared * (2 * j + 1 + odd) / (2 * j + 2 + odd)).alias("term")),
        lambda s: s["total"])
    inside = F.when(n % 2 == 1, 2.0 / math.pi * (theta + F.sin(theta) * F.cos(theta) * total)).otherwise(F.sin(theta) * total)
    far = normal_p((8 * n + 1) / (8 * n + 3) * F.sqrt(n * F.log1p(a * a / n)))
    return F.when((n > 0) & a.isNotNull(), F.when(n > EXACT_DF, far).otherwise(1 - inside))
