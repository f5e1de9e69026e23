"""Exact quantiles, ids of any size, ties inside a day or a batch, and the shared folder."""

import datetime as dt
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskwatch import session
from riskwatch.functions.windows import max_streak, prefix_sums, tail_flags
from riskwatch.operators import model as MD
from riskwatch.operators import robust
from riskwatch.sources.sinks import read_latest, sink_report, sink_scored, sink_upsert, upsert_frames


@pytest.mark.parametrize("accuracy", [10_000, 20])
def test_quantiles_are_exact(spark, monkeypatch, accuracy):
    monkeypatch.setattr(robust, "ACCURACY", accuracy)
    rnd = np.random.default_rng(accuracy)
    rows = [("a", float(x), None) for x in rnd.normal(size=700)] + [("b", float(x), 1.0) for x in rnd.integers(0, 5, 300)]
    rows += [(None, 3.0, None), ("c", None, 2.5)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(5)
    probs = (0.0, 0.01, 0.25, 0.5, 0.99, 1.0)
    one = robust.exact_quantiles(df, ["x", "y"], probs).first()
    x = np.array([r[1] for r in rows if r[1] is not None])
    assert one["_q_x"] == pytest.approx(np.quantile(x, probs).tolist(), abs=1e-12)
    assert one["_q_y"] == pytest.approx(np.quantile([1.0] * 300 + [2.5], probs).tolist())
    found = {r.g: r["_q_x"] for r in robust.exact_quantiles(df, ["x"], probs, ["g"]).collect()}
    for g in ("a", "b", None):
        own = [r[1] for r in rows if r[0] == g and r[1] is not None]
        assert found[g] == pytest.approx(np.quantile(own, probs).tolist(), abs=1e-12)


def test_split_of_large_and_string_ids(spark):
    ids = [600_000_000_000 + i for i in range(50)] + [(1 << 62) + i * (1 << 32) for i in range(50)] + [-5, -6]
    df = spark.createDataFrame([(x, i % 2) for i, x in enumerate(ids)], "customer_id long, y int")
    for frame in (df, df.withColumn("customer_id", F.concat(F.lit("c"), F.col("customer_id")))):
        split = MD.split_stratified(frame, "y", 0.2)
        sizes = {r.y: (r.n, r.t) for r in split.groupBy("y").agg(
            F.count("*").alias("n"), F.sum(F.col("is_test").cast("int")).alias("t")).collect()}
        assert sizes == {0: (51, 10), 1: (51, 10)}
        folds = MD.assign_folds(frame, "y", 5).groupBy("y", "fold").count().collect()
        assert len(folds) == 10 and {r["count"] for r in folds} <= {10, 11}
    assert MD.sample_rows(df, 7).count() == 7


def test_ties_of_the_hash_are_ranked_by_id(spark):
    rows = [("k", 5, i, 1) for i in range(6)] + [("k", 7, 9, 1)]
    df = spark.createDataFrame(rows, "g string, h long, id long, one int").repartition(3)
    found = prefix_sums(df, ["g"], "h", ["one"], tiebreak=["id"], bucket=F.shiftright("h", 1)).collect()
    assert sorted((r.id, r.cum_one) for r in found) == [(i, i + 1) for i in range(6)] + [(9, 7)]


def test_rows_of_one_day_have_an_order(spark):
    day = dt.date(2024, 1, 1)
    rows = [(1, day, "OD", 95), (1, day, "TERM", 0), (1, day + dt.timedelta(1), "OD", 95)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "id int, date date, product string, dpd int").coalesce(1)
        last = tail_flags(df, "id", "date", {"l": 2}, ["product"]).where("l").collect()
        assert sorted((str(r.date), r["product"]) for r in last) == [("2024-01-01", "TERM"), ("2024-01-02", "OD")]
        assert max_streak(df, "id", "date", "dpd", 90, ["product"]).first().max_streak == 1
    for call in (lambda: tail_flags(df, "id", "date", {"l": 1}, []), lambda: max_streak(df, "id", "date", "dpd", 90, [])):
        with pytest.raises(ValueError):
            call()


def test_one_winner_inside_a_batch(spark):
    rows = [(1, 1, "a"), (1, 3, "b"), (1, 2, "c"), (2, 1, "x"), (2, 1, "y")]
    for parts in (1, 4):
        new = spark.createDataFrame(rows, "k int, seq int, v string").repartition(parts)
        assert {r.k: r.v for r in upsert_frames(None, new, ["k"], "seq").collect()} == {1: "b", 2: "y"}


def test_partitioned_upsert_rewrites_only_its_partitions(spark):
    base = tempfile.mkdtemp() + "/t"
    sink_upsert(spark.createDataFrame([("2024-01", 1, 1.0), ("2024-02", 1, 2.0)], "m string, k int, v double"), base,
                ["m", "k"], partition_by="m")
    before = set(read_latest(spark, base, ["2024-01"]).inputFiles())
    for _ in range(2):
        sink_upsert(spark.createDataFrame([("2024-02", 1, 9.0), ("2024-02", 2, 3.0)], "m string, k int, v double"), base,
                    ["m", "k"], partition_by="m")
    found = read_latest(spark, base)
    assert sorted((r.m, r.k, r.v) for r in found.collect()) == [("2024-01", 1, 1.0), ("2024-02", 1, 9.0), ("2024-02", 2, 3.0)]
    assert before and before < set(found.inputFiles()) and read_latest(spark, base, ["2024-02"]).count() == 2


def test_scored_and_report_sinks(spark):
    base = tempfile.mkdtemp()
    scored = spark.createDataFrame([(1, 0.3), (2, 0.01)], "customer_id int, p double")
    for asof in ("2024-01-31", "2024-02-29", "2024-02-29"):
        sink_scored(scored, base + "/s", asof, {"red": 0.2, "amber": 0.05})
    assert spark.read.parquet(base + "/s").groupBy("asof").count().count() == 2
    sink_report(spark.createDataFrame([(1, [1.5, None])], "n int, l array<double>"), base + "/r")
    assert spark.read.json(base + "/r").first().n == 1


def test_train_save_load_score(spark):
    rnd = np.random.default_rng(1)
    rows = [(i, float(x), None if i % 7 == 0 else float(y), int(x + rnd.normal() / 4 > 0.8))
            for i, (x, y) in enumerate(rnd.normal(size=(300, 2)))]
    df = spark.createDataFrame(rows, "customer_id int, a double, b double, y int")
    model = MD.train_classifier(df, ["a", "b"], MD.ModelParams(label="y", rounds=5))
    path = tempfile.mkdtemp() + "/m"
    MD.save_model(model, path, spark)
    before, after = (MD.score_raw(m, df, ["customer_id"]).orderBy("customer_id").collect()
                     for m in (model, MD.load_model(spark, path)))
    assert before == after and np.corrcoef([r.score_raw for r in after], [r[3] for r in rows])[0, 1] > 0.5


def test_a_cluster_without_a_shared_folder_is_an_error(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())


def test_scenarios_from_tables(spark):
    from riskwatch.operators import stress as ST

    shocks = [(s["name"], k, float(v)) for s in ST.SCENARIOS for k, v in s["shocks"].items()] + [("Base", "unknown", 9.0)]
    factors = [(s["name"], k, v) for s in ST.SCENARIOS for k, v in s.get("sector_multipliers", {}).items()]
    tables = ST.scenarios_from_tables(spark.createDataFrame(shocks, "scenario string, factor string, shock double"),
                                      spark.createDataFrame(factors, "scenario string, sector string, multiplier double"))
    portfolio = spark.createDataFrame([(1, "Construction", "B", 0.02, 1e6, 0.4, 0.1), (2, "Retail", "D", 0.2, 5e5, 0.5, 0.2)],
                                      "customer_id int, sector string, grade string, pd_baseline double, ead double, lgd double, apr double")
    one, two = (sorted((r.scenario, r.level, r.key, round(r.el, 6)) for r in ST.stress_test(portfolio, s).collect())
                for s in (ST.SCENARIOS, tables))
    assert one == two


def test_raw_set_and_results_are_loaded(spark):
    from riskwatch.sources import adapters as A

    base = tempfile.mkdtemp()
    spark.createDataFrame([("c1", "2024-01-01", 5.0)], "customer_id string, date string, inflow double").write.parquet(
        base + "/cashflow_daily.parquet")
    for name, row in (("fin_quarterly", "customer_id,fq_date"), ("credit_daily", "customer_id,date"), ("covenant", "customer_id,date")):
        spark.createDataFrame([("c1", "2024-01-01")], row.replace(",", " string,") + " string").write.option(
            "header", True).csv(f"{base}/{name}.csv")
    raw = A.load_raw_set(spark, base)
    assert raw.labels is None and raw.cashflow.first().inflow == 5.0 and dict(raw.fin.dtypes)["fq_date"] == "timestamp"
    assert A.load_results(spark, base) == {}
    raw.cashflow.write.parquet(base + "/psi.parquet")
    assert list(A.load_results(spark, base)) == ["psi"]
