"""Registered monitoring queries and SQL oracles.

Monitored population: the scored cohort rows from 1998 on (current) against
the rows before 1998 (baseline); score = ``pd_12m``, label = ``y_event_12m``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expr import MONITOR_GRADE_BOUNDS
from ..functions.expr import stable_double_sql as R
from ..operators import calib, drift, monitor
from ..operators.calib import percent_probs
from ..session import materialize
from ..sources import adapters as A
from ..sources.io import monitoring_cutoffs
from . import params as P
from . import sql_adapters as S
from .catalog_backtest import decile_sql, rank_sql
from .catalog_stress import _d, _grade_sql
from .registry import query

SPLIT_DATE = "1998-01-01"
FEATS = ["pd_12m", "ead", "lgd"]
RUN = {"run_id": "run-0001", "date_run": "2026-01-01", "env": "batch", "model_version": "pd_12m"}
APPROVAL_CUT = 0.05


def base_cur(spark, sf):
    c = materialize(A.backtest_cohorts(spark, sf))  # read by every monitoring piece
    return c.filter(F.col("as_of_date") < F.lit(SPLIT_DATE).cast("date")), \
        c.filter(F.col("as_of_date") >= F.lit(SPLIT_DATE).cast("date"))


_B = P.BASELINE_METRICS
MON = [S.COHORTS, f"""mc AS (SELECT *, CASE WHEN as_of_date < DATE '{SPLIT_DATE}' THEN 0 ELSE 1 END AS side,
   1 AS k, pd_12m AS p, CAST(y_event_12m AS INTEGER) AS y FROM cohorts),
mcur AS (SELECT * FROM mc WHERE side = 1)""", rank_sql("k", "mcur", "mrk", signed=True), f"""
mbr AS (SELECT k, AVG(POW(y - p, 2)) AS brier FROM mcur GROUP BY k),
mm AS (SELECT mrk.auc, mrk.pr_auc, mrk.ks, mbr.brier FROM mrk JOIN mbr USING (k)),
mb AS (SELECT {_d(_B['auc'])} AS auc_base, {_d(_B['pr_auc'])} AS pr_auc_base, {_d(_B['ks'])} AS ks_base,
   {_d(_B['brier'])} AS brier_base),
mf AS (SELECT *, (auc < 0.7 OR (auc_base - auc) > 0.05) AS auc_alert,
   ((brier - brier_base) > 0.01 OR (brier_base > 0 AND ((brier - brier_base) / brier_base) > 0.2)) AS brier_alert,
   (ks_base > 0 AND ((ks_base - ks) / GREATEST(ks_base, 1e-12)) > 0.2) AS ks_alert,
   (pr_auc_base > 0 AND (pr_auc_base - COALESCE(pr_auc, 0.0)) > 0.05) AS pr_auc_alert FROM mm CROSS JOIN mb)"""]

_FLAG_COLS = ["auc", "pr_auc", "ks", "brier", "auc_base", "pr_auc_base", "ks_base", "brier_base",
              "auc_alert", "brier_alert", "ks_alert", "pr_auc_alert"]
_FD = {"auc", "pr_auc", "ks", "brier", "auc_base", "pr_auc_base", "ks_base", "brier_base"}


def rs(cols, doubles):
    return ", ".join(f"{R(c)} AS {c}" if c in doubles else c for c in cols)


def _flags(spark, sf):
    _, cur = base_cur(spark, sf)
    cm = monitor.calc_metrics(cur, "pd_12m", "y_event_12m")
    return monitor.degrade_flags(monitor.join_baseline_metrics(cm, monitor.baseline_frame(spark, _B)))


@query("holdout_metrics", S.with_(*MON) + f"SELECT {rs(['auc', 'pr_auc', 'ks', 'brier'], _FD)} FROM mm")
def q_holdout_metrics(spark, sf):
    """AUC, PR-AUC, curve KS and Brier of a scored population (current rows)."""
    _, cur = base_cur(spark, sf)
    return monitor.calc_metrics(cur, "pd_12m", "y_event_12m")


@query("join_baseline_metrics", S.with_(*MON) + f"SELECT {rs(_FLAG_COLS[:8], _FD)} FROM mm CROSS JOIN mb")
def q_join_baseline_metrics(spark, sf):
    _, cur = base_cur(spark, sf)
    cm = monitor.calc_metrics(cur, "pd_12m", "y_event_12m")
    return monitor.join_baseline_metrics(cm, monitor.baseline_frame(spark, _B))


@query("degrade_flags", S.with_(*MON) + f"SELECT {rs(_FLAG_COLS, _FD)} FROM mf")
def q_degrade_flags(spark, sf):
    return _flags(spark, sf)


DEC = [*MON, decile_sql("k", "mcur", "mdc"), """mfit AS (
  SELECT k, COUNT(*) AS n_deciles, REGR_SLOPE(round_even(odr, 5), round_even(pd_avg, 5)) AS sl,
         REGR_INTERCEPT(round_even(odr, 5), round_even(pd_avg, 5)) AS ic FROM mdc GROUP BY k)"""]


@query("decile_linear_fit", S.with_(*DEC) + f"""SELECT CAST(n_deciles AS BIGINT) AS n_deciles,
  {R('CASE WHEN n_deciles >= 3 THEN round_even(sl, 4) ELSE 1.0 END')} AS slope,
  {R('CASE WHEN n_deciles >= 3 THEN round_even(ic, 5) ELSE 0.0 END')} AS intercept,
  {R('(SELECT round_even(AVG(CAST(y AS DOUBLE)), 5) FROM mcur)')} AS expected_odr FROM mfit""")
def q_decile_linear_fit(spark, sf):
    _, cur = base_cur(spark, sf)
    d = cur.select(F.col("pd_12m").alias("_p"), F.col("y_event_12m").alias("_y"))
    return calib.decile_linear_fit(d, [], "_p", "_y", 10)[1]


GM = [*MON, f"""mg AS (SELECT {_grade_sql('p', MONITOR_GRADE_BOUNDS, open_top=False)} AS grade,
   CAST(p < {APPROVAL_CUT} AS DOUBLE) AS ok FROM mcur),
mgl AS (SELECT * FROM (VALUES ('A'), ('B'), ('C'), ('D'), ('E'), ('F'), ('G')) AS t(grade)),
mgm AS (SELECT l.grade, CAST(COALESCE(c.c, 0) AS DOUBLE) / (SELECT COUNT(*) FROM mg) AS share,
   (SELECT AVG(ok) FROM mg) AS approval_rate
   FROM mgl l LEFT JOIN (SELECT grade, COUNT(*) AS c FROM mg WHERE grade IS NOT NULL GROUP BY 1) c ON c.grade = l.grade)"""]


@query("grade_mix", S.with_(*GM) + f"SELECT grade, {rs(['share', 'approval_rate'], {'share', 'approval_rate'})} FROM mgm")
def q_grade_mix(spark, sf):
    _, cur = base_cur(spark, sf)
    return monitor.grade_mix(cur, "pd_12m", APPROVAL_CUT)


@query("data_window", S.with_(*MON) + f"""SELECT CAST(COUNT(*) AS BIGINT) AS population_size,
  {R('round_even(AVG(CAST(y AS DOUBLE)), 5)')} AS event_rate, MIN(as_of_date) AS data_window_start,
  MAX(as_of_date) AS data_window_end FROM mcur""")
def q_data_window(spark, sf):
    _, cur = base_cur(spark, sf)
    return monitor.data_window(cur, "y_event_12m", "as_of_date")


_FL = " UNION ALL ".join(
    f"SELECT side, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM mc" for c in FEATS)
_NMIN = max(50, 5 * P.PSI_BINS)
PSIM = [*GM, f"fl AS ({_FL}), flb AS (SELECT * FROM fl WHERE side = 0)",
        S.np_edges_sql("fe0", "flb", "feature", "value", percent_probs(P.PSI_BINS)), f"""
fe AS (SELECT feature, list_sort(list_distinct(e)) AS e FROM fe0),
fst AS (SELECT feature, COUNT(CASE WHEN side = 0 THEN value END) AS n_b, COUNT(CASE WHEN side = 1 THEN value END) AS n_c
        FROM fl GROUP BY 1),
fin_b AS (SELECT l.feature, l.side, len(list_filter(e[2:len(e) - 1], lambda x: x < l.value)) AS bin
          FROM fl l JOIN fe USING (feature) WHERE l.value IS NOT NULL AND l.value >= e[1] AND l.value <= e[len(e)]),
fcnt AS (SELECT feature, side, bin, COUNT(*) AS c FROM fin_b GROUP BY 1, 2, 3),
ftot AS (SELECT feature, side, SUM(c) AS tot FROM fcnt GROUP BY 1, 2),
fgrid AS (SELECT feature, UNNEST(range(0, len(e) - 1)) AS bin FROM fe),
fsh AS (SELECT g.feature, g.bin, s.side, CASE WHEN COALESCE(c.c, 0) = 0 THEN 1e-12 ELSE CAST(c.c AS DOUBLE) / t.tot END AS sh
        FROM fgrid g CROSS JOIN (VALUES (0), (1)) AS s(side)
        LEFT JOIN fcnt c ON c.feature = g.feature AND c.bin = g.bin AND c.side = s.side
        LEFT JOIN ftot t ON t.feature = g.feature AND t.side = s.side),
fpv AS (SELECT feature, bin, MAX(CASE WHEN side = 0 THEN sh END) AS e, MAX(CASE WHEN side = 1 THEN sh END) AS a FROM fsh GROUP BY 1, 2),
fpsi AS (SELECT feature, SUM((a - e) * LN(a / e)) AS psi FROM fpv GROUP BY 1),
ftab AS (SELECT st.feature, CASE WHEN st.n_b >= {_NMIN} AND st.n_c >= {_NMIN} AND len(fe.e) >= 3 THEN round_even(p.psi, 4) END AS psi
        FROM fst st LEFT JOIN fe ON fe.feature = st.feature LEFT JOIN fpsi p ON p.feature = st.feature),
po AS (SELECT COALESCE(round_even(QUANTILE_CONT(psi, 0.5), 4), 0.0) AS psi_overall,
   COUNT_IF(psi >= 0.25) AS psi_severe_count, COUNT_IF(psi >= 0.10 AND psi < 0.25) AS psi_warn_count FROM ftab)"""]


def _run(spark, sf):
    base, cur = base_cur(spark, sf)
    return monitor.monitor_run(base, cur, "pd_12m", "y_event_12m", FEATS, _B, APPROVAL_CUT, P.PSI_BINS, "as_of_date", RUN)


@query("metrics_long", S.with_(*PSIM) + f"""SELECT '{RUN['run_id']}' AS run_id, '{RUN['date_run']}' AS date_run,
  '{RUN['env']}' AS env, '{RUN['model_version']}' AS model_version, metric, {R('round_even(value, 6)')} AS value FROM (
  SELECT 'AUC' AS metric, auc AS value FROM mm UNION ALL SELECT 'PR_AUC', pr_auc FROM mm
  UNION ALL SELECT 'KS', ks FROM mm UNION ALL SELECT 'BRIER', brier FROM mm
  UNION ALL SELECT 'PSI_OVERALL', psi_overall FROM po
  UNION ALL SELECT 'ApprovalRate', (SELECT AVG(ok) FROM mg)
  UNION ALL SELECT 'Grade_' || grade, share FROM mgm)""")
def q_metrics_long(spark, sf):
    return _run(spark, sf)["metrics_long"]


def _issue_sql(flag, name, cur):
    return (f"CASE WHEN {flag} THEN '{name} is worse than its baseline: ' || CAST(round_even({cur}, 4) AS VARCHAR)"
            f" || ' against ' || CAST(round_even({cur}_base, 4) AS VARCHAR) END")


@query("issue_list", S.with_(*PSIM) + f"""SELECT CAST(n AS INTEGER) AS place, issue FROM (
  SELECT UNNEST(l) AS issue, UNNEST(range(len(l))) AS n FROM (SELECT list_filter([
    {_issue_sql('auc_alert', 'AUC', 'auc')}, {_issue_sql('ks_alert', 'KS', 'ks')},
    {_issue_sql('brier_alert', 'Brier score', 'brier')}, {_issue_sql('pr_auc_alert', 'PR-AUC', 'pr_auc')},
    CASE WHEN psi_severe_count > 0 THEN 'severe PSI in ' || psi_severe_count || ' features, first ' || (
      SELECT string_agg(feature, ', ' ORDER BY psi DESC, feature) FROM (
        SELECT * FROM ftab WHERE psi >= 0.25 ORDER BY psi DESC, feature LIMIT 5)) END,
    CASE WHEN psi_warn_count > 0 THEN 'moderate PSI in ' || psi_warn_count || ' features' END],
    lambda x: x IS NOT NULL) AS l FROM mf CROSS JOIN po))""")
def q_issue_list(spark, sf):
    """The issues of the monitoring run in order, one row a text."""
    return _run(spark, sf)["report"].select(F.posexplode("issues").alias("place", "issue"))


_REP = ["population_size", "event_rate", "auc", "pr_auc", "ks", "brier", "auc_alert", "brier_alert", "ks_alert",
        "pr_auc_alert", "slope", "intercept", "psi_overall", "psi_severe_count", "psi_warn_count", "psi_alert",
        "approval_rate", "n_issues"]
_REP_D = {"event_rate", "auc", "pr_auc", "ks", "brier", "slope", "intercept", "psi_overall", "approval_rate"}


@query("monitor_run", S.with_(*PSIM, *DEC[len(MON):]) + f"""SELECT
  (SELECT CAST(COUNT(*) AS BIGINT) FROM mcur) AS population_size,
  {R('(SELECT round_even(AVG(CAST(y AS DOUBLE)), 5) FROM mcur)')} AS event_rate,
  {R('auc')} AS auc, {R('pr_auc')} AS pr_auc, {R('ks')} AS ks, {R('brier')} AS brier,
  auc_alert, brier_alert, ks_alert, pr_auc_alert,
  {R('CASE WHEN n_deciles >= 3 THEN round_even(sl, 4) ELSE 1.0 END')} AS slope,
  {R('CASE WHEN n_deciles >= 3 THEN round_even(ic, 5) ELSE 0.0 END')} AS intercept,
  {R('psi_overall')} AS psi_overall, CAST(psi_severe_count AS BIGINT) AS psi_severe_count,
  CAST(psi_warn_count AS BIGINT) AS psi_warn_count, psi_overall >= 0.10 AS psi_alert,
  {R('(SELECT AVG(ok) FROM mg)')} AS approval_rate,
  CAST((CASE WHEN auc_alert THEN 1 ELSE 0 END) + (CASE WHEN ks_alert THEN 1 ELSE 0 END)
  + (CASE WHEN brier_alert THEN 1 ELSE 0 END) + (CASE WHEN pr_auc_alert THEN 1 ELSE 0 END)
  + (CASE WHEN psi_severe_count > 0 THEN 1 ELSE 0 END) + (CASE WHEN psi_warn_count > 0 THEN 1 ELSE 0 END) AS INTEGER) AS n_issues
FROM mf CROSS JOIN po CROSS JOIN mfit""")
def q_monitor_run(spark, sf):
    """The whole monitoring run; its one-row report (flat columns)."""
    return _run(spark, sf)["report"].select(*_REP)


@query("monitor_report")
def q_monitor_report(spark, sf):
    """The monitoring run's nested report as one JSON string."""
    return monitor.report_json(monitor.nested_report(_run(spark, sf), RUN, monitoring_cutoffs({"red": APPROVAL_CUT, "amber": P.AMBER})))


@query("monitor_psi", S.with_(*PSIM) + f"SELECT feature, {R('psi')} AS psi FROM ftab")
def q_monitor_psi(spark, sf):
    """The monitoring run's PSI table of every feature."""
    return _run(spark, sf)["psi"].select("feature", "psi")


@query("monitor_calibration", S.with_(*DEC) + f"""SELECT CAST(decile AS INTEGER) AS decile,
  {R('round_even(pd_avg, 5)')} AS pd_avg, {R('round_even(odr, 5)')} AS odr, CAST("count" AS BIGINT) AS "count" FROM mdc""")
def q_monitor_calibration(spark, sf):
    """The monitoring run's calibration deciles."""
    return _run(spark, sf)["deciles"]


@query("monitor_grades", S.with_(*GM) + f"SELECT grade, {rs(['share', 'approval_rate'], {'share', 'approval_rate'})} FROM mgm")
def q_monitor_grades(spark, sf):
    """The monitoring run's grade mix."""
    return _run(spark, sf)["grade_mix"]
