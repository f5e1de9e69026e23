"""How often the quantiles, the z-scores and the split read and move their rows."""

import re

import numpy as np
import pytest

from riskwatch.operators import model as MD
from riskwatch.operators import robust


def test_values_are_not_read_again_once_they_are_counted(spark, tmp_path, monkeypatch):
    """The rows used to be read a third time, for the values inside the brackets, and sketched as long rows."""
    plans, real = {}, robust.materialize

    def spy(df, name="table"):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(robust, "materialize", spy)
    monkeypatch.setattr(robust, "ACCURACY", 50)
    x = np.random.default_rng(5).normal(size=700)
    x[:200] = 0.5  # ties inside a bracket
    spark.createDataFrame([(float(v), None if i % 7 else float(i)) for i, v in enumerate(x)], "x double, y double").write.parquet(f"{tmp_path}/t")
    probs = [0.9, 0.1, 0.5, 1.0, 0.0]  # in any order
    got = robust.exact_quantiles(spark.read.parquet(f"{tmp_path}/t"), ["x", "y"], probs)
    assert not [f for f in got.inputFiles() if str(tmp_path) in f]
    assert "Generate" not in plans["brackets"]
    row = got.first()
    assert row["_q_x"] == pytest.approx(np.quantile(x, probs), abs=1e-12)
    assert row["_q_y"] == pytest.approx(np.quantile(np.arange(0, 700, 7), probs), abs=1e-12)


@pytest.mark.parametrize("rows, prefixes", [(12, {"_s_"}), (3, {"_s_", "_g_"})])
def test_global_quantiles_are_made_for_small_groups(spark, monkeypatch, rows, prefixes):
    """They used to be made for every table, also where no group takes them."""
    seen, real = set(), robust.exact_quantiles
    monkeypatch.setattr(robust, "exact_quantiles", lambda *a, **k: seen.add(k["prefix"]) or real(*a, **k))
    data = [("a", None, float(i)) for i in range(20)] + [("b", "s", float(i)) for i in range(rows)]
    df = spark.createDataFrame(data, "sector_code string, size_bucket string, x double")
    z = {(r.sector_code, r.x): r["x__zs_sector_size"] for r in robust.robust_zscore(df, ["x"], min_group=10).collect()}
    assert seen == prefixes
    q = np.quantile([x for _, _, x in (data if rows < 10 else data[20:])], [0.25, 0.5, 0.75])
    assert z["b", 2.0] == pytest.approx((2.0 - q[1]) / (q[2] - q[0]))
    assert z["a", 2.0] == pytest.approx((2.0 - 9.5) / 9.5)


@pytest.mark.parametrize("share", [0.0, 0.2, 1.0, 1.5])
def test_split_ranks_only_the_range_that_the_share_ends_in(spark, tmp_path, share):
    """All rows, with all their columns, used to move to be ranked."""
    rows = [(i, None if i % 10 == 0 else int(i % 3 == 0), float(i)) for i in [*range(3000), 7, 7]]
    spark.createDataFrame([*rows, (None, 1, 0.0)], "customer_id long, y int, x double").write.parquet(f"{tmp_path}/t")
    split = MD.split_stratified(spark.read.parquet(f"{tmp_path}/t"), "y", share, drop_null_labels=False)
    assert not re.search(r"hashpartitioning\(_stratum#\d+L?, _b#", split._jdf.queryExecution().executedPlan().toString())
    found = split.collect()
    assert split.columns == ["customer_id", "y", "x", "is_test"]
    assert sorted((r.customer_id, str(r.y), r.x) for r in found) == sorted((i, str(y), x) for i, y, x in rows)
    for y in (None, 0, 1):
        own = sorted((((r.customer_id * 1103515245 + 42 * 40503) % 2 ** 32, r.customer_id), not r.is_test) for r in found if r.y == y)
        n = round(len(own) * share)
        assert [not late for _, late in own] == [i < n for i in range(len(own))]
