import os

import pytest
from pyspark.sql import functions as F

from riskwatch.operators import drift as D


def test_psi_identical_is_zero_and_shift_positive(spark):
    rows = [("2024-01-31", float(i % 50)) for i in range(500)] + [("2024-02-29", float(i % 50)) for i in range(500)]
    rows += [("2024-03-31", float(i % 50) + 10) for i in range(500)]
    long = spark.createDataFrame(rows, "m string, value double").withColumn("series", F.lit("x"))
    r = {x.m: x.psi for x in D.psi_numeric(long, "m", "2024-01-31").collect()}
    assert r["2024-01-31"] == pytest.approx(0.0, abs=1e-12)
    assert r["2024-02-29"] == pytest.approx(0.0, abs=1e-12)
    assert r["2024-03-31"] > 0.1


def test_psi_categorical_new_and_missing_category(spark):
    rows = [("b", "A"), ("b", "B"), ("c", "A"), ("c", "C")]
    long = spark.createDataFrame(rows, "m string, value string").withColumn("series", F.lit("s"))
    r = {x.m: x.psi for x in D.psi_categorical(long, "m", "b").collect()}
    assert r["b"] == 0.0 and r["c"] > 0


def test_monitoring_psi_small_sample_null(spark):
    b = spark.createDataFrame([(float(i),) for i in range(49)], "x double")
    r = D.psi_feature_table(b, b, ["x"]).first()
    assert r.psi is None and r.severity == "unknown"


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_entry_and_plan_checks(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "icr_ttm__zs_sector_size" in df.columns
    qs = E.queries()
    for k in ("fin_ratios", "threshold_sweep", "stress_test"):
        plan = qs[k](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
        assert "CartesianProduct" not in plan
    fr = qs["filter_obs_window"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in fr.replace("\n", "")


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_light_plans(spark):
    import __spark_entry__ as E

    def plan(key):
        return E.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()

    assert plan("default_label").count("Exchange hashpartitioning") <= 4
    assert "CartesianProduct" not in plan("monitor_run")
    assert "percentile(" not in plan("thresholds_quota")


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_every_query_has_builder(spark):
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 100
