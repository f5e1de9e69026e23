"""Registered report views (SURVEY §2.5 pooled / CI / bands, §2.12 documented
analyses) and SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expr import stable_double_sql as R
from ..operators import backtest as BT
from ..operators import calib, ranking
from ..operators import reports as RP
from ..operators import stress as ST
from ..sources import adapters as A
from . import catalog_backtest as CB
from . import catalog_features as CF
from . import catalog_stress as CS
from . import params as P
from . import sql_adapters as S
from .registry import query

M = "as_of_month"
Z = RP.Z95


def rs(cols, doubles):
    return ", ".join(f"{R(c)} AS {c}" if c in doubles else c for c in cols)


def _monthly(spark, sf):
    d = CB.prepared(spark, sf)
    return d, BT.monthly_metrics(d, CB.bparams())


def _wilson_sql(p: str, n: str, name: str) -> str:
    nd = f"CAST({n} AS DOUBLE)"
    den = f"(1.0 + {Z * Z!r} / {nd})"
    centre = f"(({p}) + {Z * Z!r} / (2.0 * {nd})) / {den}"
    margin = f"{Z!r} * SQRT(({p}) * (1.0 - ({p})) / {nd} + {Z * Z!r} / (4.0 * {nd} * {nd})) / {den}"
    ok = f"({n} > 0 AND ({p}) IS NOT NULL)"
    return (f"{R(f'CASE WHEN {ok} THEN GREATEST(0.0, {centre} - {margin}) ELSE {p} END')} AS {name}_lo, "
            f"{R(f'CASE WHEN {ok} THEN LEAST(1.0, {centre} + {margin}) ELSE {p} END')} AS {name}_hi")


_W_SQL = ", ".join(
    f"""{R(f"CASE WHEN {n}_alerts > 0 THEN CAST({n}_tp AS DOUBLE) / {n}_alerts END")} AS {n}_precision,
  {_wilson_sql(f"CASE WHEN {n}_alerts > 0 THEN CAST({n}_tp AS DOUBLE) / {n}_alerts END", f"{n}_alerts", f"{n}_precision")},
  {R(f"CASE WHEN events > 0 THEN CAST({n}_tp AS DOUBLE) / events END")} AS {n}_recall,
  {_wilson_sql(f"CASE WHEN events > 0 THEN CAST({n}_tp AS DOUBLE) / events END", "events", f"{n}_recall")}"""
    for n in ("amber", "red"))


@query("wilson_ci", S.with_(*CB.PREP) + f"""SELECT as_of_month, {_W_SQL} FROM (
  SELECT as_of_month, SUM(y) AS events,
    COUNT_IF(p >= {P.AMBER}) AS amber_alerts, SUM(CASE WHEN p >= {P.AMBER} THEN y ELSE 0 END) AS amber_tp,
    COUNT_IF(p >= {P.RED}) AS red_alerts, SUM(CASE WHEN p >= {P.RED} THEN y ELSE 0 END) AS red_tp
  FROM cb GROUP BY as_of_month)""")
def q_wilson_ci(spark, sf):
    """Wilson 95 % intervals of precision / recall at amber and red, from real counts."""
    return RP.wilson_ci(CB.prepared(spark, sf), [M], "_p", "_y", {"amber": P.AMBER, "red": P.RED})


_SE = "SQRT(auc * (1.0 - auc) / CAST(LEAST(n_pos, n_neg) AS DOUBLE))"
_OKA = "(n_pos > 0 AND n_neg > 0 AND auc IS NOT NULL)"


@query("auc_ci", S.with_(*CB.PREP, CB.rank_sql()) + f"""SELECT as_of_month, {R('auc')} AS auc,
  {R(f'CASE WHEN {_OKA} THEN GREATEST(0.0, auc - {Z!r} * {_SE}) ELSE auc END')} AS auc_lo,
  {R(f'CASE WHEN {_OKA} THEN LEAST(1.0, auc + {Z!r} * {_SE}) ELSE auc END')} AS auc_hi FROM rk""")
def q_auc_ci(spark, sf):
    return RP.auc_ci(ranking.rank_metrics(CB.prepared(spark, sf), [M], "_p", "_y"), [M])


@query("pooled_calibration", S.with_(*CB.PREP, CB.decile_sql()) + f"""SELECT decile, {R('AVG(pd_avg)')} AS pd_avg,
  {R('AVG(odr)')} AS odr, {R('AVG(abs_err_bp)')} AS abs_err_bp, CAST(SUM(count) AS BIGINT) AS count,
  AVG(abs_err_bp) > 20 AS flag FROM dc GROUP BY decile""")
def q_pooled_calibration(spark, sf):
    return RP.pooled_calibration(calib.decile_calibration(CB.prepared(spark, sf), [M], "_p", "_y", P.N_BINS))


@query("pooled_sweep", S.with_(*CB.PREP, CB._SWEEP_SQL) + f"""SELECT {R('cut')} AS cut, {R('AVG(precision)')} AS precision,
  {R('AVG(recall)')} AS recall, {R('AVG(alert_rate)')} AS alert_rate, {R('AVG(alerts)')} AS alerts FROM sw GROUP BY cut""")
def q_pooled_sweep(spark, sf):
    return RP.pooled_sweep(ranking.threshold_sweep(CB.prepared(spark, sf), [M], "_p", "_y", P.sweep_cuts()))


_MB = " UNION ALL ".join(f"SELECT '{c}' AS metric, {c} AS v FROM mm" for c in ("auc", "ks", "brier", "pr_auc"))


@query("metric_bands", S.with_(*CB.BT_CTES) + f"""SELECT metric, {R('AVG(v)')} AS mean, {R('STDDEV_SAMP(v)')} AS std,
  {R('AVG(v) - STDDEV_SAMP(v)')} AS lower, {R('AVG(v) + STDDEV_SAMP(v)')} AS upper FROM ({_MB}) GROUP BY metric""")
def q_metric_bands(spark, sf):
    _, m = _monthly(spark, sf)
    return RP.metric_bands(m)


@query("latest_month_slice", S.with_(*CB.PREP, CB._SWEEP_SQL) + f"""SELECT {CB.rsel(CB._SWEEP_COLS, CB._SWEEP_D)} FROM sw
WHERE as_of_month = (SELECT MAX(as_of_month) FROM sw)""")
def q_latest_month_slice(spark, sf):
    return RP.latest_month_slice(ranking.threshold_sweep(CB.prepared(spark, sf), [M], "_p", "_y", P.sweep_cuts()))


@query("join_nearest_cut", S.with_(*CB.PREP, CB._SWEEP_SQL) + f"""SELECT {CB.rsel(CB._SWEEP_COLS, CB._SWEEP_D)} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY as_of_month ORDER BY ABS(cut - 0.03), cut) AS rn FROM sw) WHERE rn = 1""")
def q_join_nearest_cut(spark, sf):
    """Per month, the sweep row nearest to the 3 % cut."""
    sw = ranking.threshold_sweep(CB.prepared(spark, sf), [M], "_p", "_y", P.sweep_cuts())
    return RP.join_nearest_cut(sw, 0.03).select(*CB._SWEEP_COLS)


@query("best_worst_months", S.with_(*CB.BT_CTES) + f"""SELECT 'best' AS kind, CAST(rd AS INTEGER) AS rank, as_of_month, {R('auc')} AS auc
FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY auc DESC, as_of_month) AS rd FROM mm) WHERE rd <= 3
UNION ALL SELECT 'worst', CAST(ra AS INTEGER), as_of_month, {R('auc')}
FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY auc ASC, as_of_month) AS ra FROM mm) WHERE ra <= 3""")
def q_best_worst_months(spark, sf):
    _, m = _monthly(spark, sf)
    return RP.best_worst_months(m).withColumn("rank", F.col("rank").cast("int"))


@query("kpi_triggers", S.with_(*CB.BT_CTES) + f"""SELECT as_of_month,
  COALESCE(auc < 0.75 AND prev_auc < 0.75, FALSE) AS auc_trigger, FALSE AS psi_trigger,
  COALESCE(ABS(amber_alert_rate - base_rate) / base_rate > 0.5, FALSE) AS alert_rate_trigger FROM (
  SELECT *, LAG(auc) OVER (ORDER BY as_of_month) AS prev_auc,
    FIRST_VALUE(amber_alert_rate) OVER (ORDER BY as_of_month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS base_rate
  FROM mm)""")
def q_kpi_triggers(spark, sf):
    """Recalibration triggers per month (AUC floor twice running, alert-rate move)."""
    _, m = _monthly(spark, sf)
    t = RP.kpi_triggers(m)
    return t.select(M, F.coalesce("auc_trigger", F.lit(False)).alias("auc_trigger"), "psi_trigger",
                    "alert_rate_trigger")


@query("workload_hours", S.with_(*CB.BT_CTES) + f"""SELECT as_of_month, {R('amber_alerts * 0.5')} AS amber_hours,
  {R('red_alerts * 1.0')} AS red_hours, {R('amber_alerts * 0.5 + red_alerts * 1.0')} AS total_hours,
  {R('(amber_alerts * 0.5 + red_alerts * 1.0) / 160')} AS fte FROM mm""")
def q_workload_hours(spark, sf):
    _, m = _monthly(spark, sf)
    return RP.workload_hours(m)


@query("alert_overlap", S.with_(*CB.PREP) + f"""SELECT as_of_month, CAST(COUNT_IF(p >= {P.RED}) AS BIGINT) AS red_alerts,
  CAST(COUNT_IF(p >= {P.AMBER} AND p < {P.RED}) AS BIGINT) AS amber_only_alerts,
  {R(f'CASE WHEN COUNT_IF(p >= {P.AMBER} AND p < {P.RED}) > 0 THEN CAST(SUM(CASE WHEN p >= {P.AMBER} AND p < {P.RED} THEN y ELSE 0 END) AS DOUBLE) / COUNT_IF(p >= {P.AMBER} AND p < {P.RED}) END')} AS amber_only_precision,
  {R(f'CASE WHEN SUM(y) > 0 THEN CAST(SUM(CASE WHEN p >= {P.AMBER} AND p < {P.RED} THEN y ELSE 0 END) AS DOUBLE) / SUM(y) END')} AS amber_only_recall,
  COUNT_IF(p >= {P.RED} AND p < {P.AMBER}) = 0 AS red_subset_of_amber FROM cb GROUP BY as_of_month""")
def q_alert_overlap(spark, sf):
    return RP.alert_overlap(CB.prepared(spark, sf), [M], "_p", "_y", P.AMBER, P.RED)


@query("capture_rate", S.with_(*CB.PREP) + f"""SELECT as_of_month, {R('c10')} AS capture_10pct, {R('c20')} AS capture_20pct FROM (
  SELECT as_of_month,
    CAST(SUM(CASE WHEN rn <= GREATEST(1, FLOOR(CAST(t AS DOUBLE) * CAST(0.1 AS DOUBLE))) THEN y ELSE 0 END) AS DOUBLE) / GREATEST(SUM(y), 1) AS c10,
    CAST(SUM(CASE WHEN rn <= GREATEST(1, FLOOR(CAST(t AS DOUBLE) * CAST(0.2 AS DOUBLE))) THEN y ELSE 0 END) AS DOUBLE) / GREATEST(SUM(y), 1) AS c20
  FROM (SELECT as_of_month, y, ROW_NUMBER() OVER (PARTITION BY as_of_month ORDER BY p DESC, row_id) AS rn,
               COUNT(*) OVER (PARTITION BY as_of_month) AS t FROM cb) GROUP BY as_of_month)""")
def q_capture_rate(spark, sf):
    """Share of the month's events caught in the top 10 % / 20 % of scores."""
    lf = ranking.lift_at_k(CB.prepared(spark, sf), [M], "_p", "_y", (0.1, 0.2), "row_id")
    return lf.groupBy(M).agg(F.max(F.when(F.col("frac") == 0.1, F.col("capture"))).alias("capture_10pct"),
                             F.max(F.when(F.col("frac") == 0.2, F.col("capture"))).alias("capture_20pct"))


_SEG_X = """sgx0 AS (SELECT *, CASE WHEN ead < 100000 THEN 'Small' WHEN ead <= 300000 THEN 'Medium' ELSE 'Large' END AS segment FROM cb),
sgx AS (SELECT sgx0.* FROM sgx0 JOIN (SELECT as_of_month AS km, segment AS ks FROM sgx0 GROUP BY 1, 2
        HAVING COUNT(*) >= 30) k ON sgx0.as_of_month = k.km AND sgx0.segment = k.ks)"""


@query("exposure_bucket", S.with_(*CB.PREP, _SEG_X, *CB.cohort_sql("as_of_month, segment", "sgx", "x_"))
       + f"SELECT as_of_month, 'exposure' AS segment_col, segment, {CB.rsel(CB._METRIC_COLS, CB._METRIC_D)} FROM x_cm")
def q_exposure_bucket(spark, sf):
    """Backtest metrics by exposure size bucket (Small < 100k <= Medium <= 300k < Large)."""
    d = CB.prepared(spark, sf).withColumn("exposure", RP.exposure_bucket("ead", 1e5, 3e5))
    return BT.segment_metrics(d, CB.bparams(min_records=30), "exposure")


# ---------------------------------------------------------------------------
# stress reports
# ---------------------------------------------------------------------------
def _results(spark, sf):
    return ST.stress_test(CS.portfolio(spark, sf))


@query("stress_contribution", S.with_(*CS.STRESS) + f"""SELECT a.scenario, a.level, a.key, {R('a.delta_npl_proxy', 0)} AS delta_npl_proxy,
  {R('a.delta_npl_proxy / b.npl_proxy * 100')} AS pct_increase,
  {R('a.delta_npl_proxy / SUM(a.delta_npl_proxy) OVER (PARTITION BY a.level)')} AS share_of_delta
FROM sd a LEFT JOIN (SELECT * FROM sd WHERE scenario = 'Base') b ON a.level = b.level AND a.key = b.key
WHERE a.scenario = 'Severe_Recession' AND a.level <> 'overall'""", of=CS.SUMS)
def q_stress_contribution(spark, sf):
    return RP.stress_contribution(_results(spark, sf), "Severe_Recession")


@query("stress_traffic_light", S.with_(*CS.STRESS) + f"""SELECT scenario, {R('dc', 0)} AS delta_capital, {R('dp', 0)} AS delta_provision,
  CASE WHEN dc > 10e6 OR dp > 30e6 THEN 'Red' WHEN dc > 6e6 OR dp > 20e6 THEN 'Orange'
       WHEN dc >= 3e6 OR dp >= 10e6 THEN 'Amber' ELSE 'Green' END AS band FROM (
  SELECT scenario, COALESCE(delta_capital, 0.0) AS dc, COALESCE(delta_provision, 0.0) AS dp FROM sd WHERE level = 'overall')""", of=CS.SUMS)
def q_stress_traffic_light(spark, sf):
    return RP.stress_traffic_light(_results(spark, sf))


_SENS = """sens AS (SELECT scenario, em, ls, ead, LEAST(GREATEST(lgd + ls, 0.0), 1.0) AS lgd,
   LEAST(GREATEST((1.0 / (1.0 + EXP(-(z - shift + shift * em)))) * mult, 1e-6), 0.5) AS p
   FROM sx CROSS JOIN (VALUES (CAST(0.8 AS DOUBLE)), (CAST(1.0 AS DOUBLE)), (CAST(1.2 AS DOUBLE))) AS e(em)
   CROSS JOIN (VALUES (CAST(-0.1 AS DOUBLE)), (CAST(0.0 AS DOUBLE)), (CAST(0.1 AS DOUBLE))) AS l(ls))"""


@query("stress_sensitivity", S.with_(*CS.STRESS, _SENS) + f"""SELECT scenario, {R('em')} AS elasticity_mult, {R('ls')} AS lgd_shift,
  {R('SUM(p * ead)', 0)} AS npl_proxy, {R('SUM(p * lgd * ead)', 0)} AS provision,
  {R('SUM(CAST(0.08 AS DOUBLE) * ead * SQRT(LEAST(GREATEST(p * lgd, 0.0), 1.0)))', 0)} AS capital
FROM sens GROUP BY scenario, em, ls""", of=CS.SUMS)
def q_stress_sensitivity(spark, sf):
    """Overall NPL / provision / capital under elasticity x 0.8 / 1 / 1.2 and LGD -/+ 10 pp."""
    return RP.stress_sensitivity(CS.portfolio(spark, sf))


_FROM = P.days_before(P.PANEL_ASOF, P.OBS_DAYS)
_EXTRA = f"""cr AS (SELECT *, utilized / NULLIF(credit_limit, 0) AS util FROM credit
  WHERE date >= DATE '{_FROM}' AND date <= DATE '{P.PANEL_ASOF}'),
eb AS (SELECT customer_id, MAX(util) AS util_max, COUNT_IF(util > 0.8) AS days_util_gt80, AVG(dpd_days) AS dpd_mean,
  COUNT_IF(dpd_days > 30) AS days_dpd_gt30 FROM cr GROUP BY 1),
es AS (SELECT customer_id, CAST(MAX(r) AS BIGINT) AS dpd_max_streak FROM (
  SELECT customer_id, g, COUNT_IF(ok) AS r FROM (
    SELECT customer_id, COALESCE(dpd_days >= 1, FALSE) AS ok, COUNT_IF(NOT COALESCE(dpd_days >= 1, FALSE)) OVER (
      PARTITION BY customer_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g FROM cr) GROUP BY 1, 2) GROUP BY 1),
ec AS (SELECT customer_id, AVG(inflow - outflow) AS cf_net_mean, COUNT_IF(inflow - outflow < 0) AS cf_negative_days,
  STDDEV_SAMP(inflow - outflow) AS cf_volatility FROM cash
  WHERE date >= DATE '{_FROM}' AND date <= DATE '{P.PANEL_ASOF}' GROUP BY 1),
eg AS (SELECT customer_id, (revenue - before) / NULLIF(ABS(before), 0) AS revenue_qoq_growth FROM (
  SELECT customer_id, revenue, LAG(revenue) OVER w AS before, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY fq_date DESC) AS rn
  FROM fin WINDOW w AS (PARTITION BY customer_id ORDER BY fq_date)) WHERE rn = 1)"""


@query("extra_behavior", S.with_(S.CREDIT, S.CASH, S.FIN, _EXTRA) + f"""SELECT COALESCE(eb.customer_id, ec.customer_id) AS customer_id,
  {R('util_max', 8)} AS util_max, CAST(days_util_gt80 AS BIGINT) AS days_util_gt80, {R('dpd_mean', 8)} AS dpd_mean,
  CAST(days_dpd_gt30 AS BIGINT) AS days_dpd_gt30, dpd_max_streak, {R('cf_net_mean', 8)} AS cf_net_mean,
  CAST(cf_negative_days AS BIGINT) AS cf_negative_days, {R('cf_volatility', 8)} AS cf_volatility,
  {R('revenue_qoq_growth', 8)} AS revenue_qoq_growth
FROM eb LEFT JOIN es USING (customer_id) FULL OUTER JOIN ec ON ec.customer_id = eb.customer_id
LEFT JOIN eg ON eg.customer_id = COALESCE(eb.customer_id, ec.customer_id)""", digits=8)
def q_extra_behavior(spark, sf):
    """Documented extra behaviour / cash-flow / growth features per customer."""
    return RP.extra_behavior(A.credit_daily(spark, sf), A.cashflow_daily(spark, sf), A.fin_quarterly(spark, sf),
                             P.PANEL_ASOF, P.OBS_DAYS)


# ---------------------------------------------------------------------------
# append-safe history (sink_upsert / union_history) on two overlapping runs
# ---------------------------------------------------------------------------
_UP_KEYS = ["as_of_month", "pd_col", "y_col", "amber", "red"]
_RUNS_SQL = """old_run AS (SELECT *, 'r1' AS run FROM mm WHERE as_of_month <= DATE '2000-12-31'),
new_run AS (SELECT *, 'r2' AS run FROM mm WHERE as_of_month >= DATE '2000-01-01'),
hist AS (SELECT as_of_month, pd_col, y_col, amber, red, auc, ks, run, 0 AS batch FROM old_run
         UNION ALL SELECT as_of_month, pd_col, y_col, amber, red, auc, ks, run, 1 FROM new_run)"""


def _runs(spark, sf):
    _, m = _monthly(spark, sf)
    m = m.select(*_UP_KEYS, "auc", "ks")
    old = m.filter(F.col(M) <= F.lit("2000-12-31").cast("date")).withColumn("run", F.lit("r1"))
    new = m.filter(F.col(M) >= F.lit("2000-01-01").cast("date")).withColumn("run", F.lit("r2"))
    return old, new


@query("union_history", S.with_(*CB.BT_CTES, _RUNS_SQL) + f"""SELECT {rs(_UP_KEYS + ['auc', 'ks', 'run'], {'amber', 'red', 'auc', 'ks'})},
  CAST(batch AS INTEGER) AS batch FROM hist""")
def q_union_history(spark, sf):
    """Old run rows followed by new run rows (the history before de-duplication)."""
    from ..sources.sinks import union_history
    old, new = _runs(spark, sf)
    return union_history(old, new).withColumnRenamed("_batch", "batch")


@query("sink_upsert", S.with_(*CB.BT_CTES, _RUNS_SQL) + f"""SELECT {rs(_UP_KEYS + ['auc', 'ks', 'run'], {'amber', 'red', 'auc', 'ks'})}
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY as_of_month, pd_col, y_col, amber, red ORDER BY batch DESC) AS rn FROM hist)
WHERE rn = 1""")
def q_sink_upsert(spark, sf):
    """Upsert of a second backtest run into the first (keys: month, pd, label, cuts):
    overlapping months take the new run, the rest stay. ``sink_upsert`` writes the
    same merge as a new version folder."""
    from ..sources.sinks import upsert_frames
    old, new = _runs(spark, sf)
    return upsert_frames(old, new, _UP_KEYS)
