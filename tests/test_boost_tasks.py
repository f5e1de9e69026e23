"""Boosted trees: how models are dealt to tasks."""

from pyspark.sql import functions as F

from riskwatch.operators import boost
from riskwatch.operators import model as MD


def frame(spark, n):
    x = [F.when(F.rand(9 + j) > 0.1, F.round(F.randn(j), 1)).alias(c) for j, c in enumerate("abc")]
    d = spark.range(n).select("id", *x)
    return d.withColumn("y", (F.coalesce("a", F.lit(0)) * F.coalesce("b", F.lit(1)) + F.randn(5) > 1).cast("int"))


def test_jobs_do_not_grow_with_levels_and_rounds(spark):
    """A table beyond 50,000 rows used to take a job for every level of every tree."""
    df = frame(spark, 60_000).withColumn("fold", (F.col("id") % 2).cast("int"))
    sc = spark.sparkContext
    sc.setJobGroup("boost-jobs", "")
    try:
        model = MD.train_classifier(df, ["a", "b", "c"], MD.ModelParams(label="y", rounds=5), "fold", 2)
        jobs = len(sc.statusTracker().getJobIdsForGroup("boost-jobs"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert [len(m.trees) for m in model.models] == [5, 5, 5] and jobs <= 12


def test_same_trees_with_models_without_rows(spark):
    """A fold that has all rows leaves its model none."""
    p = boost.BoostParams(rounds=3, num_leaves=5, max_depth=3, max_bins=8, learning_rate=0.3)
    df = frame(spark, 400)
    for fold in ((F.col("id") % 2).cast("int"), F.lit(0)):
        d = df.withColumn("fold", fold)
        one, many = (boost.train(d, ["a", "b", "c"], "y", p, "fold", 2, rows_per_task=n) for n in (1_000, 90))
        assert one == many and [len(m.trees) for m in one.models] == [3, 3, 3]
