"""Hand goldens for the feature build (FIXTURES §3)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskwatch.functions.windows import max_streak, tail_flags
from riskwatch.operators import features as FE
from riskwatch.operators.robust import robust_zscore, winsorize

FIN_SCHEMA = ("customer_id int, fq_date date, sector_code string, size_bucket string, revenue double, "
              "cogs double, ebitda double, ebit double, interest_expense double, total_debt double, "
              "current_assets double, current_liab double, inventory double, ar double, ap double")


def fin_row(cid, q, interest=1.0, revenue=100.0):
    return (cid, dt.date(2024, 3 * q - 2, 1), "MFG", "SME", revenue, 60.0, 40.0, 35.0, interest, 50.0,
            80.0, 40.0, 20.0, 30.0, 10.0)


def test_one_quarter_deltas_null(spark):
    df = spark.createDataFrame([fin_row(1, 1)], FIN_SCHEMA)
    r = FE.fin_ratios(df).collect()[0]
    assert r.dso == pytest.approx(365 * 30 / 100) and r.delta_dso_qoq is None and r.delta_ccc_qoq is None


def test_zero_interest_gives_null_icr(spark):
    df = spark.createDataFrame([fin_row(1, q, interest=0.0) for q in range(1, 5)], FIN_SCHEMA)
    r = FE.fin_ratios(df).collect()[0]
    assert r.icr_ttm is None and r.dscr_ttm_proxy is None


def test_ttm_partial_window_and_missing(spark):
    rows = [fin_row(1, q, revenue=None if q == 2 else 10.0) for q in range(1, 5)]
    df = spark.createDataFrame(rows, FIN_SCHEMA)
    t = FE.ttm_rolling(df).orderBy("fq_date").collect()
    assert [x.revenue_ttm for x in t] == [10.0, 10.0, 20.0, 30.0]


def test_max_streak_runs(spark):
    def cust(cid, flags):
        return [(cid, dt.date(2024, 1, 1) + dt.timedelta(days=i), 90 if f else 0) for i, f in enumerate(flags)]
    rows = cust(1, [1] * 29) + cust(2, [1] * 30) + cust(3, [1] * 15 + [0] + [1] * 15)
    df = spark.createDataFrame(rows, "customer_id int, date date, dpd_days int")
    s = {r.customer_id: r.max_streak for r in max_streak(df, "customer_id", "date", "dpd_days", 90, ["dpd_days"]).collect()}
    assert s == {1: 29, 2: 30, 3: 15}


def test_default_label_rule(spark):
    rows = [(1, dt.date(2025, 7, 1) + dt.timedelta(days=i), 95) for i in range(30)]
    rows += [(2, dt.date(2025, 7, 1) + dt.timedelta(days=i), 95) for i in range(29)]
    df = spark.createDataFrame(rows, "customer_id int, date date, dpd_days int")
    lab = {r.customer_id: r.event_h12m for r in FE.default_label(df, "2025-06-30").collect()}
    assert lab == {1: 1, 2: 0}


def test_tail_flags_exact(spark):
    rows = [(1, dt.date(2024, 1, d), d) for d in range(1, 11)] + [(2, dt.date(2024, 1, 1), 0)]
    df = spark.createDataFrame(rows, "customer_id int, date date, v int")
    out = tail_flags(df, "customer_id", "date", {"last3": 3}, ["v"]).filter("last3").collect()
    assert sorted((r.customer_id, r.v) for r in out) == [(1, 8), (1, 9), (1, 10), (2, 0)]


def test_npe_exclusion_boundary(spark):
    rows = [(1, dt.date(2025, 6, 30), 90), (2, dt.date(2025, 6, 23), 95)]
    df = spark.createDataFrame(rows, "customer_id int, date date, dpd_days int")
    bad = [r.customer_id for r in FE.npe_customers(df, "2025-06-30").collect()]
    assert bad == [1]


def test_near_due_null_without_recent_rows(spark):
    rows = [(1, dt.date(2025, 6, 1), 100.0, 50.0, 0, 10)]
    df = spark.createDataFrame(rows, "customer_id int, date date, credit_limit double, utilized double, "
                                     "breach_flag int, dpd_days int")
    r = FE.behavior_features(df, FE.FeatureParams(asof="2025-06-30")).collect()[0]
    assert r.near_due_freq_7d is None and r.dpd_trend_180d == 0.0


def test_dpd_trend_slope(spark):
    rows = [(1, dt.date(2025, 6, 1) + dt.timedelta(days=i), 100.0, 50.0, 0, i) for i in range(10)]
    df = spark.createDataFrame(rows, "customer_id int, date date, credit_limit double, utilized double, "
                                     "breach_flag int, dpd_days int")
    r = FE.behavior_features(df, FE.FeatureParams(asof="2025-06-30")).collect()[0]
    assert r.dpd_trend_180d == pytest.approx(1.0)


def test_timestamp_vs_day_granularity(spark):
    rows = [(1, dt.datetime(2025, 6, 30, 23, 59, 59, 999999), 1)]
    df = spark.createDataFrame(rows, "customer_id int, date timestamp, breach_flag int")
    ts = FE.covenant_features(df, "2025-06-30", 180, "timestamp").count()
    day = FE.covenant_features(df, "2025-06-30", 180, "day").count()
    assert (ts, day) == (0, 1)


def test_robust_zscore_small_group_and_zero_iqr(spark):
    rows = [(f"A", "SME", float(i)) for i in range(9)]            # 9 rows -> global stats
    rows += [("B", "SME", 5.0) for _ in range(10)]                # IQR 0, median 5 -> scale 5
    rows += [("C", "SME", 0.0) for _ in range(10)]                # IQR 0, median 0 -> scale 1
    rows += [(None, "SME", float(i)) for i in range(10)]          # NULL sector is its own group
    df = spark.createDataFrame(rows, "sector_code string, size_bucket string, x double")
    z = robust_zscore(df, ["x"])
    b = z.filter("sector_code = 'B'").select("x__zs_sector_size").first()[0]
    c = z.filter("sector_code = 'C'").select("x__zs_sector_size").first()[0]
    assert b == 0.0 and c == 0.0
    n = z.filter(F.col("sector_code").isNull() & (F.col("x") == 9.0)).first()["x__zs_sector_size"]
    assert n == pytest.approx((9.0 - 4.5) / (6.75 - 2.25))
    import numpy as np
    allx = np.array([r.x for r in df.collect()])
    med, iqr = np.median(allx), np.percentile(allx, 75) - np.percentile(allx, 25)
    a8 = z.filter("sector_code = 'A' AND x = 8.0").first()["x__zs_sector_size"]
    assert a8 == pytest.approx((8.0 - med) / iqr)


def test_winsorize_bounds(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(None,)], "x double")
    w = winsorize(df, ["x"], 0.01, 0.99)
    vals = [r.x for r in w.collect()]
    assert min(v for v in vals if v is not None) == pytest.approx(1.0)
    assert max(v for v in vals if v is not None) == pytest.approx(99.0)
    assert any(v is None for v in vals)
