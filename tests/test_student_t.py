"""Student-t critical values: published table values and commons-math3 in
Spark's own JVM as independent references."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plotcover.functions.student_t import (cornish_fisher_t, critical_values, t_table,
                                           with_t_critical)

# Published two-sided 95% critical values.
PUBLISHED = {1: 12.7062, 2: 4.3027, 5: 2.5706, 10: 2.2281, 30: 2.0423}


def _commons(spark, dof, p):
    dist = spark._jvm.org.apache.commons.math3.distribution.TDistribution(None, float(dof), 1e-15)
    return dist.inverseCumulativeProbability(p)


def test_published_values():
    got = critical_values(np.array(list(PUBLISHED)))
    for (dof, expected), value in zip(PUBLISHED.items(), got):
        assert round(value, 4) == expected


@pytest.mark.parametrize("confidence", [0.95, 0.9, 0.99])
def test_against_commons_math(spark, confidence):
    dofs = np.array([1, 2, 3, 4, 7, 15, 34, 100, 181, 500, 1000])
    got = critical_values(dofs, confidence)
    for dof, value in zip(dofs, got):
        assert value == pytest.approx(_commons(spark, dof, (1 + confidence) / 2), abs=1e-10)


def test_table_join_and_expansion(spark):
    df = spark.createDataFrame([(d,) for d in (-1, 0, 1, 34, 1000, 1001, 50000)], "dof int")
    got = {r.dof: r.t_crit for r in with_t_critical(df).collect()}
    assert got[-1] is None and got[0] is None
    for d in (1, 34, 1000, 1001, 50000):
        assert got[d] == pytest.approx(_commons(spark, d, 0.975), abs=1e-10)
    assert t_table(spark).count() == 1000


def test_expansion_column(spark):
    df = spark.range(1).select(cornish_fisher_t(F.lit(2000)).alias("t"))
    assert df.first().t == pytest.approx(_commons(spark, 2000, 0.975), abs=1e-12)
