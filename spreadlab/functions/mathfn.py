"""Numeric column expressions: guarded log, normal CDF, Engle-Granger p-value,
logistic scoring and signal thresholds.  All are plain Spark SQL expressions so
they stay inside whole-stage codegen."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (published constants, must not change):
#
# MacKinnon (1994) response-surface approximation of the Engle-Granger
# cointegration test p-value, two variables, regression with constant:
#   small tau  (tau <= -2.62): p = Phi(2.92 + 1.5012 tau + 0.039796 tau^2)
#   large tau  (tau >  -2.62): p = Phi(2.1945 + 0.64695 tau - 0.29198 tau^2 - 0.042377 tau^3)
#   p = 0 for tau < -18.86 and p = 1 for tau > 0.92
#
# Abramowitz & Stegun 26.2.17 normal CDF, |error| < 7.5e-8:
#   t = 1 / (1 + 0.2316419 |x|)
#   Q = phi(x) t (0.319381530 + t(-0.356563782 + t(1.781477937 + t(-1.821255978 + 1.330274429 t))))
# ---------------------------------------------------------------------------
EG_TAU_STAR = -2.62
EG_TAU_MIN = -18.86
EG_TAU_MAX = 0.92
EG_SMALL = (2.92, 1.5012, 0.039796)
EG_LARGE = (2.1945, 0.64695, -0.29198, -0.042377)
AS_P = 0.2316419
AS_B = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
INV_SQRT_2PI = 1.0 / math.sqrt(2.0 * math.pi)

# Reference thresholds (fixed values)
LOGRET_JUMP = 0.5          # |d ln price| above this drops a PnL row
BETA_MIN, BETA_MAX = 0.1, 10.0
SCORE_LONG, SCORE_SHORT = 0.55, 0.45
STD_EPS = 1e-12
SCREEN_MIN_ABS_CORR = 0.7
SCREEN_P_MAX = 0.05


def safe_log(x: Column) -> Column:
    """Natural log, null for x <= 0 or null (never NaN/-inf, never raises)."""
    return F.ln(F.when(x > F.lit(0.0), x))


def _horner(x: Column, coefs) -> Column:
    """c0 + c1 x + c2 x^2 + ... evaluated in Horner form."""
    acc = F.lit(float(coefs[-1]))
    for c in reversed(coefs[:-1]):
        acc = F.lit(float(c)) + x * acc
    return acc


def norm_cdf(x: Column) -> Column:
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(AS_P) * F.abs(x))
    pdf = F.lit(INV_SQRT_2PI) * F.exp(-(x * x) / F.lit(2.0))
    poly = t * _horner(t, AS_B)
    upper = pdf * poly
    return F.when(x >= F.lit(0.0), F.lit(1.0) - upper).otherwise(upper)


def eg_pvalue(tau: Column) -> Column:
    small = norm_cdf(_horner(tau, EG_SMALL))
    large = norm_cdf(_horner(tau, EG_LARGE))
    return (F.when(tau.isNull(), F.lit(None).cast("double"))
            .when(tau < F.lit(EG_TAU_MIN), F.lit(0.0))
            .when(tau > F.lit(EG_TAU_MAX), F.lit(1.0))
            .when(tau <= F.lit(EG_TAU_STAR), small)
            .otherwise(large))


def _norm_ppf(p: float) -> float:
    """Inverse normal CDF by bisection on math.erf (driver-side constant only)."""
    lo, hi = -40.0, 40.0
    for _ in range(200):
        mid = (lo + hi) / 2
        if 0.5 * (1 + math.erf(mid / math.sqrt(2))) < p:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2


def eg_tau_threshold(p_max: float = SCREEN_P_MAX) -> float:
    """tau* with p(tau*) = p_max on the small-tau branch, so that p < p_max <=> tau < tau*.

    The decision is taken on tau (exact arithmetic in every engine) rather than
    on the approximated p-value."""
    z = _norm_ppf(p_max)
    c0, c1, c2 = EG_SMALL
    c0 = c0 - z
    disc = c1 * c1 - 4 * c2 * c0
    root = (-c1 + math.sqrt(disc)) / (2 * c2)
    if root > EG_TAU_STAR:  # p_max so large that the threshold leaves the branch
        lo, hi = EG_TAU_STAR, EG_TAU_MAX
        for _ in range(200):
            mid = (lo + hi) / 2
            v = sum(c * mid ** i for i, c in enumerate(EG_LARGE))
            if 0.5 * (1 + math.erf(v / math.sqrt(2))) < p_max:
                lo = mid
            else:
                hi = mid
        root = (lo + hi) / 2
    return root


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def linear_score(features, coef, mean, scale, intercept) -> Column:
    """intercept + sum_i coef_i * (x_i - mean_i) / scale_i; zero scale counts as 1."""
    terms = []
    for name, w, mu, sc in zip(features, coef, mean, scale):
        sc = 1.0 if sc == 0.0 else float(sc)
        terms.append(F.lit(float(w)) * ((F.col(name) - F.lit(float(mu))) / F.lit(sc)))
    return reduce(lambda a, b: a + b, terms, F.lit(float(intercept)))


def score_signal(prob: Column, long_at: float = SCORE_LONG, short_at: float = SCORE_SHORT) -> Column:
    """Scoring convention: inclusive thresholds; null/NaN probability -> 0."""
    ok = prob.isNotNull() & ~F.isnan(prob)
    return (F.when(ok & (prob >= F.lit(long_at)), F.lit(1))
            .when(ok & (prob <= F.lit(short_at)), F.lit(-1))
            .otherwise(F.lit(0))).cast("int")


def proba_signal(prob: Column, long_above: float = SCORE_LONG, short_below: float = SCORE_SHORT) -> Column:
    """Report convention: strict thresholds (> long, < short), else 0."""
    return (F.when(prob > F.lit(long_above), F.lit(1))
            .when(prob < F.lit(short_below), F.lit(-1))
            .otherwise(F.lit(0))).cast("int")


def guarded_z(x: Column, mean: Column, std: Column, eps: float = STD_EPS) -> Column:
    """(x - mean) / std when std > eps, else 0.0 (null std counts as 0)."""
    return F.when(std > F.lit(eps), (x - mean) / std).otherwise(F.lit(0.0))
