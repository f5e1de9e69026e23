"""How the quantile passes count."""

from riskwatch.operators import robust


def test_long_rows_are_counted_without_a_sort(spark, monkeypatch):
    """The bracket's ends, arrays, used to go through the aggregation that counts, which sorted all long rows for it."""
    plans, real = {}, robust.materialize

    def spy(df, name="table"):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(robust, "materialize", spy)
    df = spark.createDataFrame([(g, float(i)) for i in range(20) for g in ("a", None)], "g string, x double")
    found = {r.g: r["_q_x"] for r in robust.exact_quantiles(df, ["x"], [0.25, 0.5], ["g"]).collect()}
    assert found == {"a": [4.75, 9.5], None: [4.75, 9.5]}
    assert "HashAggregate" in plans["ranks"] and "SortAggregate" not in plans["ranks"]
