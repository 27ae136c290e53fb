"""Two-sided Student-t critical values as Spark data.

Spark has no Student-t quantile.  The critical value depends only on the
degrees of freedom, so a bounded table (dof 1 .. ``max_dof``, 1,000 rows by
default) is computed once per process with numpy and broadcast-joined on the
dof column; its size is fixed by ``max_dof``, not by the data.  Beyond
``max_dof`` the Cornish-Fisher expansion (Abramowitz & Stegun 26.7.5) is a
plain Column expression, accurate to about 1e-13 there.  dof <= 0 gives NULL.
"""

from __future__ import annotations

import math
from functools import lru_cache
from statistics import NormalDist

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_DOF = 1000


def _log_beta(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.array([math.lgamma(p) + math.lgamma(q) - math.lgamma(p + q)
                     for p, q in zip(a.tolist(), b.tolist())])


def _incomplete_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray,
                     lbeta: np.ndarray, max_iterations: int = 1000) -> np.ndarray:
    """Regularised incomplete beta I_x(a, b), y = 1 - x given separately to
    keep precision, lbeta = log B(a, b); continued fraction by the modified
    Lentz method, evaluated on whichever side converges."""
    swap = x >= (a + 1.0) / (a + b + 2.0)
    aa, bb = np.where(swap, b, a), np.where(swap, a, b)
    xx, yy = np.where(swap, y, x), np.where(swap, x, y)
    with np.errstate(divide="ignore"):
        front = np.exp(aa * np.log(xx) + bb * np.log(yy) - lbeta) / aa
    tiny = 1e-300
    c = np.ones_like(xx)
    d = 1.0 - (aa + bb) * xx / (aa + 1.0)
    d = np.where(np.abs(d) < tiny, tiny, d)
    d = 1.0 / d
    f = d.copy()
    for m in range(1, max_iterations + 1):
        m2 = 2 * m
        for num in (m * (bb - m) * xx / ((aa + m2 - 1.0) * (aa + m2)),
                    -(aa + m) * (aa + bb + m) * xx / ((aa + m2) * (aa + m2 + 1.0))):
            d = 1.0 + num * d
            d = np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + num / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            d = 1.0 / d
            step = d * c
            f = f * step
        if np.all(np.abs(step - 1.0) < 1e-15):
            break
    value = front * f
    return np.where(swap, 1.0 - value, value)


def _expansion(nu, confidence: float):
    """Cornish-Fisher terms of the two-sided critical value; works on floats,
    numpy arrays and Spark Columns alike."""
    z = NormalDist().inv_cdf((1.0 + confidence) / 2.0)
    g1 = (z**3 + z) / 4.0
    g2 = (5 * z**5 + 16 * z**3 + 3 * z) / 96.0
    g3 = (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384.0
    g4 = (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160.0
    return z, z + g1 / nu + g2 / (nu * nu) + g3 / (nu * nu * nu) + g4 / (nu * nu * nu * nu)


def critical_values(dofs: np.ndarray, confidence: float = 0.95) -> np.ndarray:
    """|t| with P(-t < T < t) = confidence for each dof (> 0).

    Newton steps on the two-sided tail I_{v/(v+t^2)}(v/2, 1/2), started from
    the expansion.  The tail is convex and falling in t, so a step from below
    never passes the root and one from above lands below it; steps are kept
    above the normal quantile, a bound every t quantile exceeds."""
    nu = np.asarray(dofs, dtype=float)
    alpha = 1.0 - confidence
    a, b = nu / 2.0, np.full_like(nu, 0.5)
    lbeta = _log_beta(a, b)
    log_norm = np.array([math.lgamma((v + 1.0) / 2.0) - math.lgamma(v / 2.0)
                         for v in nu.tolist()]) - 0.5 * np.log(nu * math.pi)
    z, t = _expansion(nu, confidence)
    t = np.maximum(t, z)
    for _ in range(12):
        t2 = t * t
        tail = _incomplete_beta(a, b, nu / (nu + t2), t2 / (nu + t2), lbeta)
        density = np.exp(log_norm - (nu + 1.0) / 2.0 * np.log1p(t2 / nu))
        t = np.maximum(t + (tail - alpha) / (2.0 * density), z)
    return t


@lru_cache(maxsize=16)
def _table_rows(confidence: float, max_dof: int) -> tuple[tuple[int, float], ...]:
    dofs = np.arange(1, max_dof + 1)
    return tuple(zip(dofs.tolist(), critical_values(dofs, confidence).tolist()))


def t_table(spark: SparkSession, confidence: float = 0.95,
            max_dof: int = DEFAULT_MAX_DOF) -> DataFrame:
    """DataFrame (dof int, t_crit double), one row per dof 1 .. max_dof."""
    schema = T.StructType([T.StructField("dof", T.IntegerType(), False),
                           T.StructField("t_crit", T.DoubleType(), False)])
    return spark.createDataFrame(list(_table_rows(float(confidence), int(max_dof))), schema)


def cornish_fisher_t(dof: Column | str, confidence: float = 0.95) -> Column:
    """Large-dof expansion of the two-sided critical value as a Column."""
    nu = (F.col(dof) if isinstance(dof, str) else dof).cast("double")
    return _expansion(nu, confidence)[1]


def with_t_critical(df: DataFrame, dof_col: str = "dof", out_col: str = "t_crit",
                    confidence: float = 0.95, max_dof: int = DEFAULT_MAX_DOF) -> DataFrame:
    """Add the critical value for each row's dof: broadcast join with the
    bounded table up to ``max_dof``, the expansion above it, NULL at dof <= 0."""
    spark = df.sparkSession
    table = t_table(spark, confidence, max_dof).withColumnRenamed("t_crit", "_t_table")
    table = table.withColumnRenamed("dof", "_t_dof")
    joined = df.join(F.broadcast(table), F.col(dof_col) == F.col("_t_dof"), "left")
    dof = F.col(dof_col)
    value = (F.when(dof > F.lit(max_dof), cornish_fisher_t(dof, confidence))
             .when(dof >= F.lit(1), F.col("_t_table")))
    return joined.withColumn(out_col, value).drop("_t_dof", "_t_table")
