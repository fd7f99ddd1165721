import math

import pytest
from pyspark.sql import functions as F

from riskloom.functions.special import chi2_tail, gamma_tail, log_gamma, normal_two_sided


def slow_chi2_tail(value, dof):
    half, a = value / 2, 0.5 if dof % 2 else 1.0
    if half <= 0:
        return 1.0
    total = math.erfc(math.sqrt(half)) if dof % 2 else math.exp(-half)
    while a < dof / 2:
        total += math.exp(a * math.log(half) - half - math.lgamma(a + 1))
        a += 1
    return min(total, 1.0)


def test_tails_match_the_closed_forms(spark):
    rows = [
        (x, k)
        for k in (1, 2, 3, 4, 7, 33, 1000, 9999, 1_000_000)
        for x in (0.0, 1e-3, 0.5 * k, 1.0 * k, 1.02 * k, k + 3 * math.sqrt(2 * k), 2.0 * k + 30)
    ]
    df = spark.createDataFrame(rows, "x double, k int")
    found = df.select("*", chi2_tail(F.col("x"), F.col("k")).alias("p"), normal_two_sided(F.col("x")).alias("z"), log_gamma(F.col("k") / 2).alias("g"))
    for r in found.collect():
        assert r.p == pytest.approx(slow_chi2_tail(r.x, r.k), rel=1e-7, abs=1e-12)
        assert r.z == pytest.approx(math.erfc(r.x / math.sqrt(2)), rel=1e-9, abs=1e-14)
        assert r.g == pytest.approx(math.lgamma(r.k / 2), rel=1e-12, abs=1e-12)
    odd = spark.createDataFrame([(None, 3), (-1.0, 3), (5.0, 0)], "x double, k int")
    assert [r[0] for r in odd.select(chi2_tail(F.col("x"), F.col("k"))).collect()] == [None, 1.0, 1.0]
    assert odd.select(gamma_tail(F.lit(None).cast("double"), 1.0)).first()[0] is None
    assert odd.select(normal_two_sided(F.col("x"))).first()[0] is None


def test_no_python_in_the_plan(spark):
    plan = spark.range(3).select(chi2_tail(F.col("id"), F.lit(3)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
