"""Aggregates and windowed statistics of the valuation, exact and JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Scale that makes the median absolute deviation estimate a normal spread.
MAD_SCALE = 1.4826


def trimmed_mean(entries: Column, share: Column) -> Column:
    """Mean of an array of (value, weight), each value as often as its weight says, less ``floor(n * share)`` at each end; null if empty."""

    total = lambda ordered: F.aggregate(ordered, F.lit(0).cast("long"), lambda s, e: s + e["weight"])

    def of(x: Column) -> Column:
        n, cut = x["n"], x["cut"]
        start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0.0).alias("sum"))

        def add(s: Column, e: Column) -> Column:
            here = F.greatest(F.lit(0), F.least(s["at"] + e["weight"], n - cut) - F.greatest(s["at"], cut))
            return F.struct((s["at"] + e["weight"]).alias("at"), (s["sum"] + here * e["value"]).alias("sum"))

        return F.when(n > 0, F.aggregate(x["ordered"], start, add, lambda s: s["sum"]) / F.greatest(n - 2 * cut, F.lit(1)))

    # named once, so that it is neither sorted again for each use nor summed up again for each entry
    named = F.transform(F.array(F.sort_array(entries)), lambda x: F.struct(x.alias("ordered"), total(x).alias("n"), F.floor(total(x) * share).alias("cut")))
    return F.element_at(F.transform(named, of), 1)


def ols_slope(y: Column, x: Column) -> Column:
    """Slope of a least-squares line; 0 with fewer than two points or a constant x."""
    return F.when(F.count(x) >= 2, F.coalesce(F.regr_slope(y, x), F.lit(0.0))).otherwise(0.0)


def ols_r2(y: Column, x: Column) -> Column:
    """Share explained; 0 if x or y is constant (the built-in says null or 1)."""
    return F.when((F.regr_syy(y, x) > 0) & (F.regr_sxx(y, x) > 0), F.greatest(F.lit(0.0), F.regr_r2(y, x))).otherwise(0.0)


def slope_error(y: Column, x: Column) -> Column:
    """Standard error of the slope; null with under three points or a constant x."""
    sxx, syy, sxy = F.regr_sxx(y, x), F.regr_syy(y, x), F.regr_sxy(y, x)
    rest = F.greatest(F.lit(0.0), syy - sxy * sxy / sxx)
    return F.when((F.count(x) >= 3) & (sxx > 0), F.sqrt(rest / (F.count(x) - 2) / sxx))


def variation(x: Column) -> Column:
    """Coefficient of variation; 0 with fewer than two values or a mean of 0."""
    return F.when((F.count(x) >= 2) & (F.avg(x) != 0), F.stddev_pop(x) / F.avg(x)).otherwise(0.0)
