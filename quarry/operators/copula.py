"""Gaussian-copula synthesizer.

Fit: every row gets the middle of its value's interval in the sorted column
(range buckets and their offsets, no join on the value); its normal score is
``probit(mid-interval / N)``; the d x d correlation of the scores is the
only thing that reaches the driver (Cholesky there).
Sample: per row, independent normals from a seeded hash (Box-Muller, so
the draw does not depend on partitioning or retries), correlated through
the Cholesky factor, mapped to uniforms with the normal CDF and back to
values with the distributed order-statistic lookup.

Spark SQL has no ``erf``/``probit``: both are closed-form polynomial /
rational approximations written as column expressions.
"""
from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.sampling import order_stat_lookup, unit_hash
from quarry.operators.windows import mid_ranks

__all__ = ["normal_cdf", "probit", "CopulaModel", "fit_copula", "sample_copula"]

# Abramowitz & Stegun 7.1.26 erf coefficients.
_AS_P = 0.3275911
_AS_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
# Acklam's inverse-normal rational approximation coefficients.
_AK_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
         1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
_AK_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
         6.680131188771972e+01, -1.328068155288572e+01)
_AK_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
         -2.549671010584440e+00, 4.374664141464968e+00, 2.938163982698783e+00)
_AK_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
         3.754408661907416e+00)


def _poly(x: Column, coefs) -> Column:
    acc = F.lit(coefs[0])
    for c in coefs[1:]:
        acc = acc * x + F.lit(c)
    return acc


def normal_cdf(z: Column) -> Column:
    """Phi(z) via A&S 7.1.26 (abs error < 1.5e-7)."""
    x = F.abs(z) / F.lit(math.sqrt(2.0))
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(_AS_P) * x)
    a1, a2, a3, a4, a5 = _AS_A
    poly = t * (F.lit(a1) + t * (F.lit(a2) + t * (F.lit(a3) + t * (F.lit(a4) + t * F.lit(a5)))))
    erf = F.lit(1.0) - poly * F.exp(-x * x)
    return F.when(z >= 0, (F.lit(1.0) + erf) / 2).otherwise((F.lit(1.0) - erf) / 2)


def probit(p: Column) -> Column:
    """Phi^-1(p) via Acklam's approximation (relative error < 1.2e-9)."""
    lo = 0.02425
    q_low = F.sqrt(F.lit(-2.0) * F.log(p))
    q_high = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - p))
    q = p - F.lit(0.5)
    r = q * q
    central = _poly(r, _AK_A) * q / (_poly(r, _AK_B) * r + F.lit(1.0))
    low = _poly(q_low, _AK_C) / (_poly(q_low, _AK_D) * q_low + F.lit(1.0))
    high = -_poly(q_high, _AK_C) / (_poly(q_high, _AK_D) * q_high + F.lit(1.0))
    return F.when(p < lo, low).when(p > 1 - lo, high).otherwise(central)


@dataclass
class CopulaModel:
    source: DataFrame
    columns: list[str]
    chol: np.ndarray
    corr: np.ndarray


def fit_copula(df: DataFrame, cols: Sequence[str], n_buckets: int | None = None) -> CopulaModel:
    cols = list(cols)
    ranked = mid_ranks(df.select(*cols), cols, n_buckets)
    scored = ranked.select(*[probit(F.col(f"_p_{c}")).alias(f"_z_{c}") for c in cols])
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    row = scored.agg(*[F.corr(f"_z_{a}", f"_z_{b}").alias(f"{a}|{b}") for a, b in pairs]).first() if pairs else None
    d = len(cols)
    corr = np.eye(d)
    for a, b in pairs:
        v = row[f"{a}|{b}"] if row is not None else 0.0
        i, j = cols.index(a), cols.index(b)
        corr[i, j] = corr[j, i] = 0.0 if v is None else float(v)
    jitter = 0.0
    while True:
        try:
            chol = np.linalg.cholesky(corr + jitter * np.eye(d))
            break
        except np.linalg.LinAlgError:
            jitter = max(1e-9, jitter * 10)
    return CopulaModel(df, cols, chol, corr)


def sample_copula(spark: SparkSession, model: CopulaModel, n: int, seed: int = 42,
                  id_col: str = "row_id") -> DataFrame:
    base = spark.range(n).withColumnRenamed("id", id_col)
    d = len(model.columns)
    normals = []
    for k in range(d):
        u1 = (unit_hash(id_col, seed, f"n{k}a") * F.lit(4294967296.0) + F.lit(0.5)) / F.lit(4294967296.0)
        u2 = unit_hash(id_col, seed, f"n{k}b")
        normals.append(F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2))
    cols = [F.col(id_col)]
    for j, c in enumerate(model.columns):
        z = None
        for k in range(j + 1):
            term = F.lit(float(model.chol[j, k])) * normals[k]
            z = term if z is None else z + term
        cols.append(normal_cdf(z).alias(f"_u_{c}"))
    u = base.select(*cols)
    out = base
    for c in model.columns:
        nc = model.source.select(F.count(c)).scalar()
        draws = u.select(id_col, F.least(F.floor(F.col(f"_u_{c}") * nc), nc - 1).cast("bigint").alias("pos"))
        got = order_stat_lookup(model.source, c, draws).select(id_col, c)
        out = out.join(got, id_col, "left")
    return out
