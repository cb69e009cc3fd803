"""Column forms of the statistics behind drift and evaluation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabwatch.schema import MonitorConfig


def ks_pvalue(statistic: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic two-sided Kolmogorov p-value.

    Series 2*sum((-1)^(k-1) exp(-2 k^2 L^2)) with the usual small-sample correction of L; below
    L = 0.2 the series converges too slowly and the value is 1 to double precision.
    """
    root = F.sqrt(n.cast("double") * m / (n + m))
    lam = (root + 0.12 + F.lit(0.11) / root) * statistic

    def term(acc: Column, k: Column) -> Column:
        kd = k.cast("double")
        sign = F.when(k % 2 == 1, 2.0).otherwise(-2.0)
        return acc + sign * F.exp(F.lit(-2.0) * kd * kd * lam * lam)

    series = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0), term)
    return F.when(lam < 0.2, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))


def floored(proportion: Column, floor: float) -> Column:
    """A zero or absent proportion becomes the floor, so its logarithm stays finite."""
    return F.when(proportion > 0, proportion).otherwise(F.lit(floor))


def psi_term(reference: Column, production: Column, floor: float) -> Column:
    r, p = floored(reference, floor), floored(production, floor)
    return (p - r) * F.ln(p / r)


def severity(psi: Column, config: MonitorConfig) -> Column:
    return (
        F.when(psi >= config.psi_critical, "critical")
        .when(psi >= config.psi_warning, "warning")
        .when(psi.isNotNull(), "none")
    )


def display_status(score: Column, drifted: Column, band: Column) -> Column:
    """Text shown beside a feature in a drift table."""
    return (
        F.when(score.isNull(), "No data")
        .when(drifted & band.isNotNull(), F.concat(F.lit("Drift detected ("), band, F.lit(")")))
        .when(drifted, "Drift detected")
        .otherwise("No drift")
    )


def ratio_or_zero(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))
