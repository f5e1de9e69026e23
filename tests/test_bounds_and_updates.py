"""Bounded rank selection, PSI from counts, mergeable streaks, the range join of cuts, and the kept backtest."""

import datetime as dt
import json
import math
import os
import tempfile

import numpy as np
import pytest

from riskwatch.functions.windows import max_streak
from riskwatch.operators import backtest as BT
from riskwatch.operators import drift as D
from riskwatch.operators import ranking, robust
from riskwatch.sources.sinks import read_latest

SF = "/root/testdata/sf0.001"
DAY = dt.date(2024, 1, 1)


# ---- quantiles ---------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("rows_to_broadcast", [100_000, 0])
def test_quantiles_with_bounded_windows(spark, monkeypatch, rows_to_broadcast):
    """However many rows a bracket holds, no more than BOUND values are ranked in one place."""
    for name, value in (("BOUND", 40), ("ACCURACY", 20), ("GRID", 8), ("BROADCAST_ROWS", rows_to_broadcast)):
        monkeypatch.setattr(robust, name, value)
    narrow, largest = robust._narrowed, []

    def spy(values, ranks, group):
        before = values.groupBy(*group).count().agg({"count": "max"}).first()[0]
        values, ranks = narrow(values, ranks, group)
        largest.append((before, values.groupBy(*group).count().agg({"count": "max"}).first()[0]))
        return values, ranks

    monkeypatch.setattr(robust, "_narrowed", spy)
    rnd = np.random.default_rng(3)
    rows = []
    for g, n in (("a", 3000), ("b", 700), (None, 300), ("c", 1), ("d", 2)):
        x, y = rnd.normal(size=n), np.round(rnd.normal(size=n), 1)  # y has ties
        y[: n // 3] = 0.5  # one value holds a third of the rows
        rows += [(g, float(a), None if i % 11 == 0 else float(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame([*rows, ("e", None, None)], "g string, x double, y double").repartition(4).cache()
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0]
    found = {r.g: r for r in robust.exact_quantiles(df, ["x", "y"], probs, ["g"]).collect()}
    for g in ("a", "b", None, "c", "d"):
        for c, i in (("x", 1), ("y", 2)):
            want = [r[i] for r in rows if r[0] == g and r[i] is not None]
            got = found[g]["_q_" + c]
            assert got == (pytest.approx(np.quantile(want, probs), abs=1e-12) if want else None), (g, c)
    assert found["e"]["_q_x"] is None
    whole = robust.exact_quantiles(df, ["x"], probs).first()["_q_x"]
    assert whole == pytest.approx(np.quantile([r[1] for r in rows], probs), abs=1e-12)
    assert max(b for b, _ in largest) > 40 >= max(a for _, a in largest)


def test_a_bracket_without_the_rank_is_opened(spark, monkeypatch):
    """A sketch that is wrong beyond its promise costs time, not the result."""
    monkeypatch.setattr(robust, "ACCURACY", 50)
    real = robust.F.percentile_approx
    monkeypatch.setattr(robust.F, "percentile_approx", lambda c, p, a: robust.F.transform(real(c, p, a), lambda x: x + 1.5))
    x = np.random.default_rng(4).normal(size=900)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = robust.exact_quantiles(df, ["x"], [0.1, 0.5, 0.95]).first()["_q_x"]
    assert got == pytest.approx(np.quantile(x, [0.1, 0.5, 0.95]), abs=1e-12)


# ---- PSI ---------------------------------------------------------------------------------------------------------

def plain_category_psi(rows, base, eps=1e-5):
    """rows: (series, period, value) -> {(series, period): psi}."""
    out = {}
    for s in {r[0] for r in rows}:
        share = {}
        for m in {r[1] for r in rows}:
            own = [r[2] for r in rows if r[0] == s and r[1] == m and r[2] is not None]
            share[m] = {v: own.count(v) / len(own) for v in own}
        for m in share:
            cats = share[m].keys() | share[base].keys()
            a = {v: share[m].get(v, 0) + eps for v in cats}
            e = {v: share[base].get(v, 0) + eps for v in cats}
            out[s, m] = sum((a[v] - e[v]) * math.log(a[v] / e[v]) for v in cats)
    return out


def test_category_psi_by_closed_form(spark):
    rnd = np.random.default_rng(5)
    rows = [(s, f"m{m}", None if rnd.random() < 0.1 else f"{s}{rnd.integers(0, 4 + m)}") for s in "xy" for m in range(4) for _ in range(40)]
    rows += [("x", "m4", None), ("y", "m4", "new"), ("z", "m0", None), ("z", "m1", "q")]
    rows += [("z", m, None) for m in ("m2", "m3", "m4")]
    df = spark.createDataFrame(rows, "series string, m string, value string").repartition(3)
    got = {(r.series, r.m): r.psi for r in D.psi_categorical(df, "m", "m0").collect()}
    want = plain_category_psi(rows, "m0")
    assert got.keys() == {(r[0], r[1]) for r in rows}
    for k, v in got.items():
        assert v == pytest.approx(want[k], abs=1e-10), k
    sizes = {(r.series, r._m): r.n_categories for r in D.category_union(
        df.selectExpr("series", "m as _m", "value", "m = 'm0' as _is_base")).collect()}
    for s, m in got:
        n = len({r[2] for r in rows if r[0] == s and r[1] in (m, "m0")} - {None})
        assert sizes.get((s, m), 0) == n


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_psi_plans(spark):
    import __spark_entry__ as E
    for key in ("psi_monthly", "psi_feature_table", "psi_categorical", "join_psi_category"):
        plan = E.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") <= 12, key
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, key


# ---- cuts --------------------------------------------------------------------------------------------------------

def test_cut_join_repeats_no_row(spark):
    rnd = np.random.default_rng(6)
    rows = [("g%d" % (i % 2), None if i % 13 == 0 else round(float(rnd.random()), 2), int(rnd.random() < 0.3)) for i in range(300)]
    df = spark.createDataFrame([*rows, ("h", 0.0, 0)], "g string, p double, y int").repartition(2)
    cuts = [0.9, 0.1, 0.5, 0.25]
    found = ranking.join_cut_theta(df, ["g"], "p", "y", cuts)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    swept = ranking.threshold_sweep(df, ["g"], "p", "y", cuts)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, swept.select(*found.columns).collect()), key=str)


# ---- streaks -----------------------------------------------------------------------------------------------------

def plain_streak(flags):
    best = now = 0
    for f in flags:
        now = now + 1 if f else 0
        best = max(best, now)
    return best


@pytest.mark.parametrize("days", [1, 5, 400])
def test_streaks_over_spans(spark, days):
    rnd = np.random.default_rng(7)
    rows = []
    for k in range(12):
        limit = rnd.choice([0.2, 0.5, 0.95])
        for d in range(rnd.integers(0, 60)):
            for n in range(rnd.integers(0, 3)):  # some days without a row, some with two
                dpd = None if rnd.random() < 0.05 else int(100 * (rnd.random() < limit))
                rows.append((k, DAY + dt.timedelta(days=int(d)), n, dpd))
    rows += [(99, DAY + dt.timedelta(days=i % 200), i, 95) for i in range(2000)]  # one hot key, never broken
    rows += [(98, None, 1, 95), (98, None, 2, 95), (98, DAY, 1, 95)]
    df = spark.createDataFrame(rows, "k int, d date, n int, dpd int").repartition(4)
    found = {r.k: r.s for r in max_streak(df, "k", "d", "dpd", 90, ["n"], name="s", days=days).collect()}
    for k in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1] or dt.date.min, r[2]))
        assert found[k] == plain_streak([r[3] is not None and r[3] >= 90 for r in own]), k


def test_a_hot_key_is_split(spark):
    df = spark.createDataFrame([(1, DAY + dt.timedelta(days=i), i, 95) for i in range(64)], "k int, d date, n int, dpd int")
    plan = max_streak(df, "k", "d", "dpd", 90, ["n"])._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert len(windows) == 1 and "_span" in windows[0].split("windowspecdefinition(")[1].split("ASC")[0]


# ---- the kept backtest -------------------------------------------------------------------------------------------

def test_updates_equal_a_rebuild(spark):
    rnd = np.random.default_rng(8)
    rows = []
    for i in range(900):
        month = 1 + i % 5
        pd_ = float(rnd.random())
        rows.append((i, i % 150, dt.date(2024, month, 1 + i % 20), None if i % 97 == 0 else pd_, int(rnd.random() < pd_)))
    df = spark.createDataFrame(rows, "row_id int, customer_id int, as_of_date date, pd_12m double, y int").cache()
    p = BT.BacktestParams("2024-01", "2024-12", y_col="y", tiebreak="row_id", min_records=20, amber=0.3, red=0.6)
    base = tempfile.mkdtemp() + "/kept"
    first = BT.update_backtest(df.where("row_id < 500"), base, p)
    assert first.count() == 5
    untouched = set(read_latest(spark, f"{base}/cohorts", ["2024-01-31"]).inputFiles())
    late = df.where("row_id >= 500 and month(as_of_date) <> 1")
    BT.update_backtest(late, base, p)
    assert untouched == set(read_latest(spark, f"{base}/cohorts", ["2024-01-31"]).inputFiles())
    got = BT.update_backtest(df.where("row_id >= 500"), base, p)  # rows that came before change nothing
    want = BT.backtest_monthly(df, p)["metrics"]
    names = sorted(want.columns)
    assert sorted(names) == sorted(got.columns)
    a, b = ([tuple(r) for r in x.select(*names).orderBy("as_of_month").collect()] for x in (got, want))
    assert len(a) == 5 and a == [tuple(pytest.approx(v) if isinstance(v, float) else v for v in r) for r in b]
    nothing = BT.update_backtest(df.where("false"), base, p)
    assert nothing.count() == 5
    fresh = BT.update_backtest(df.where("false"), tempfile.mkdtemp() + "/none", p)
    assert fresh.count() == 0 and sorted(fresh.columns) == names


def test_a_month_that_falls_below_the_floor(spark):
    """A late row that blanks a score can end a cohort."""
    rows = [(i, i, dt.date(2024, 1, 10), 0.1 * (i % 9), i % 2) for i in range(20)]
    df = spark.createDataFrame(rows, "row_id int, customer_id int, as_of_date date, pd_12m double, y int")
    p = BT.BacktestParams("2024-01", "2024-12", y_col="y", tiebreak="row_id", min_records=20)
    base = tempfile.mkdtemp() + "/kept"
    assert BT.update_backtest(df, base, p).count() == 1
    earlier = spark.createDataFrame([(99, 3, dt.date(2024, 1, 9), None, 1)], df.schema)  # the first row of a customer counts
    assert BT.update_backtest(earlier, base, p).count() == 0


# ---- the nested report -------------------------------------------------------------------------------------------

@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_nested_report(spark):
    import __spark_entry__ as E
    qs = E.queries()
    report = json.loads(qs["monitor_report"](spark, SF).first().report_json)
    flat = qs["monitor_run"](spark, SF).first()
    assert list(report) == ["run", "data_window", "baseline_metrics", "current_metrics", "cutoffs", "approval_rate", "grade_mix",
                            "calibration", "psi", "data_quality", "alert_thresholds", "alerts", "issues"]
    assert report["data_window"]["population_size"] == flat.population_size and len(report["issues"]) == flat.n_issues
    for m in ("auc", "pr_auc", "ks", "brier"):
        assert report["current_metrics"][m] == pytest.approx(flat[m], abs=1e-6) and report["alerts"][f"{m}_alert"] == flat[f"{m}_alert"]
    assert [g["grade"] for g in report["grade_mix"]] == list("ABCDEFG")
    assert report["calibration"]["slope"] == pytest.approx(flat.slope)
    deciles = qs["monitor_calibration"](spark, SF).collect()
    assert [d["decile"] for d in report["calibration"]["deciles"]] == sorted(r.decile for r in deciles)
    psi = {r.feature: r.psi for r in qs["monitor_psi"](spark, SF).collect()}
    assert {f["feature"]: f["psi"] for f in report["psi"]["psi_by_feature"]} == pytest.approx(psi)
    assert report["psi"]["psi_severe_count"] == flat.psi_severe_count
