"""Registered backtest / rank-metric queries and SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import stable_double_sql as R
from ..operators import backtest as BT
from ..operators import calib, ranking
from ..session import materialize, shared_path
from ..sources import adapters as A
from . import params as P
from . import sql_adapters as S
from .registry import ORACLE, query

M = "as_of_month"
SEGMENT_MIN = 30


def bparams(**kw) -> BT.BacktestParams:
    base = dict(start=P.MONTH_START, end=P.MONTH_END, pd_col="pd_12m", y_col="y_event_12m",
                tiebreak="row_id", amber=P.AMBER, red=P.RED, min_records=P.MIN_RECORDS,
                cuts=tuple(P.sweep_cuts()), n_bins=P.N_BINS)
    base.update(kw)
    return BT.BacktestParams(**base)


def prepared(spark: SparkSession, sf: str, **kw) -> DataFrame:
    """Prepared cohort rows, checkpointed once: every metric reads them several times."""
    return materialize(BT.prepare_cohorts(A.backtest_cohorts(spark, sf), bparams(**kw)))


def _last_day(ym: str) -> str:
    import calendar
    y, m = map(int, ym.split("-"))
    return f"{y:04d}-{m:02d}-{calendar.monthrange(y, m)[1]:02d}"


_MS, _ME = _last_day(P.MONTH_START), _last_day(P.MONTH_END)
_N = P.MIN_RECORDS

# prepared cohort: month range -> dedup -> size -> dropna -> size -> clip
PREP = [S.COHORTS, f"""cb0 AS (
  SELECT *, last_day(as_of_date) AS as_of_month FROM cohorts
  WHERE last_day(as_of_date) >= DATE '{_MS}' AND last_day(as_of_date) <= DATE '{_ME}'),
cb1 AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY as_of_month, customer_id ORDER BY as_of_date, row_id) AS rn
    FROM cb0) WHERE rn = 1),
cb2 AS (SELECT * FROM cb1 WHERE as_of_month IN (
  SELECT as_of_month FROM cb1 GROUP BY 1 HAVING COUNT(*) >= {_N})),
cb3 AS (SELECT * FROM cb2 WHERE pd_12m IS NOT NULL AND y_event_12m IS NOT NULL),
cb AS (
  SELECT *, LEAST(GREATEST(pd_12m, 1e-6), 1 - 1e-6) AS p, CAST(y_event_12m AS INTEGER) AS y FROM cb3
  WHERE as_of_month IN (SELECT as_of_month FROM cb3 GROUP BY 1 HAVING COUNT(*) >= {_N}))"""]


def rank_sql(keys: str = "as_of_month", src: str = "cb", name: str = "rk", signed: bool = False) -> str:
    """Per-score counts -> cumulative -> AUC / KS / AP per ``keys``."""
    ks = ("GREATEST(MAX(CAST(cn AS DOUBLE) / tot_neg - CAST(cp AS DOUBLE) / tot_pos), 0.0)" if signed
          else "MAX(ABS(CAST(cp AS DOUBLE) / tot_pos - CAST(cn AS DOUBLE) / tot_neg))")
    return f"""{name}_cnt AS (
  SELECT {keys}, p, SUM(y) AS np, COUNT(*) - SUM(y) AS nn, COUNT(*) AS c FROM {src} GROUP BY {keys}, p),
{name}_cum AS (
  SELECT *, SUM(np) OVER w AS cp, SUM(nn) OVER w AS cn, SUM(c) OVER w AS cc FROM {name}_cnt
  WINDOW w AS (PARTITION BY {keys} ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
{name}_tot AS (SELECT {keys}, SUM(np) AS tot_pos, SUM(nn) AS tot_neg FROM {name}_cnt GROUP BY {keys}),
{name} AS (
  SELECT {keys},
    CASE WHEN tot_pos > 0 AND tot_neg > 0 THEN SUM(np * (cn - nn + nn / 2.0)) / (CAST(tot_pos AS DOUBLE) * tot_neg) END AS auc,
    CASE WHEN tot_pos > 0 AND tot_neg > 0 THEN {ks} END AS ks,
    CASE WHEN tot_pos > 0 THEN SUM(CASE WHEN np > 0 THEN np * CAST(tot_pos - cp + np AS DOUBLE)
         / ((tot_pos - cp + np) + (tot_neg - cn + nn)) END) / tot_pos END AS pr_auc,
    CAST(tot_pos AS BIGINT) AS n_pos, CAST(tot_neg AS BIGINT) AS n_neg
  FROM {name}_cum JOIN {name}_tot USING ({keys}) GROUP BY {keys}, tot_pos, tot_neg)"""


def lift_sql(keys: str = "as_of_month", src: str = "cb", name: str = "lf") -> str:
    return f"""{name}_r AS (
  SELECT {keys}, y, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY p DESC, row_id) AS rn,
         COUNT(*) OVER (PARTITION BY {keys}) AS t, AVG(y) OVER (PARTITION BY {keys}) AS br FROM {src}),
{name} AS (
  SELECT {keys},
    AVG(CASE WHEN rn <= GREATEST(1, FLOOR(CAST(t AS DOUBLE) * CAST(0.1 AS DOUBLE))) THEN y END) / (MAX(br) + 1e-12) AS lift_10pct,
    AVG(CASE WHEN rn <= GREATEST(1, FLOOR(CAST(t AS DOUBLE) * CAST(0.2 AS DOUBLE))) THEN y END) / (MAX(br) + 1e-12) AS lift_20pct
  FROM {name}_r GROUP BY {keys})"""


def eval_sql(keys: str = "as_of_month", src: str = "cb", name: str = "te") -> str:
    parts = []
    for nm, cut in (("amber", P.AMBER), ("red", P.RED)):
        parts.append(f"""CAST(COUNT_IF(p >= {cut}) AS DOUBLE) / COUNT(*) AS {nm}_alert_rate,
    CASE WHEN COUNT_IF(p >= {cut}) > 0 THEN CAST(SUM(CASE WHEN p >= {cut} THEN y ELSE 0 END) AS DOUBLE) / COUNT_IF(p >= {cut}) END AS {nm}_precision,
    CASE WHEN SUM(y) > 0 THEN CAST(SUM(CASE WHEN p >= {cut} THEN y ELSE 0 END) AS DOUBLE) / SUM(y) END AS {nm}_recall,
    CAST(COUNT_IF(p >= {cut}) AS BIGINT) AS {nm}_alerts""")
    return f"{name} AS (SELECT {keys}, " + ",\n    ".join(parts) + f" FROM {src} GROUP BY {keys})"


_METRIC_COLS = ["auc", "ks", "brier", "pr_auc", "lift_10pct", "lift_20pct"] + [
    f"{n}_{m}" for n in ("amber", "red") for m in ("alert_rate", "precision", "recall", "alerts")]
_METRIC_D = set(_METRIC_COLS) - {"amber_alerts", "red_alerts"}


def cohort_sql(keys: str = "as_of_month", src: str = "cb", prefix: str = "") -> list[str]:
    return [rank_sql(keys, src, prefix + "rk"), lift_sql(keys, src, prefix + "lf"),
            eval_sql(keys, src, prefix + "te"),
            f"{prefix}br AS (SELECT {keys}, AVG(POW(y - p, 2)) AS brier FROM {src} GROUP BY {keys})",
            f"""{prefix}cm AS (SELECT * FROM {prefix}rk JOIN {prefix}br USING ({keys})
                JOIN {prefix}lf USING ({keys}) JOIN {prefix}te USING ({keys}))"""]


# Means of scores on a three-decimal grid have exact halves in the seventh place, which engines round apart.
MEANS = 8


def rsel(cols, doubles, digits: int = 6) -> str:
    return ", ".join(f"{R(c, digits)} AS {c}" if c in doubles else c for c in cols)


_COHORT_COLS = ["row_id", "customer_id", "as_of_date", "as_of_month", "sector", "grade", "pd_12m",
                "y_event_12m", "ead", "lgd"]
_COHORT_D = {"pd_12m", "ead", "lgd"}


# ---------------------------------------------------------------------------
# cohort preparation operators
# ---------------------------------------------------------------------------
@query("filter_month_range", S.with_(S.COHORTS) + f"""SELECT {rsel(_COHORT_COLS, _COHORT_D)} FROM (
  SELECT *, last_day(as_of_date) AS as_of_month FROM cohorts)
WHERE as_of_month >= DATE '{_MS}' AND as_of_month <= DATE '{_last_day('2001-05')}'""")
def q_filter_month_range(spark, sf):
    """Month range with the last 3 immature months dropped."""
    d = A.backtest_cohorts(spark, sf).withColumn(M, BT.month_key("as_of_date"))
    return BT.filter_month_range(d, P.MONTH_START, P.MONTH_END, drop_last_n=3).select(*_COHORT_COLS)


@query("dedup_cohort", S.with_(*PREP) + f"SELECT {rsel(_COHORT_COLS, _COHORT_D)} FROM cb1")
def q_dedup_cohort(spark, sf):
    d = A.backtest_cohorts(spark, sf).withColumn(M, BT.month_key("as_of_date"))
    d = BT.filter_month_range(d, P.MONTH_START, P.MONTH_END)
    return BT.dedup_cohort(d, [M, "customer_id"], ["as_of_date", "row_id"]).select(*_COHORT_COLS)


@query("filter_min_records", S.with_(*PREP) + f"SELECT {rsel(_COHORT_COLS, _COHORT_D)} FROM cb2")
def q_filter_min_records(spark, sf):
    d = A.backtest_cohorts(spark, sf).withColumn(M, BT.month_key("as_of_date"))
    d = BT.filter_month_range(d, P.MONTH_START, P.MONTH_END)
    d = BT.dedup_cohort(d, [M, "customer_id"], ["as_of_date", "row_id"])
    return BT.filter_min_records(d, [M], P.MIN_RECORDS).select(*_COHORT_COLS)


@query("dropna_subset", S.with_(*PREP) + f"SELECT {rsel(_COHORT_COLS, _COHORT_D)} FROM cb3")
def q_dropna_subset(spark, sf):
    d = A.backtest_cohorts(spark, sf).withColumn(M, BT.month_key("as_of_date"))
    d = BT.filter_month_range(d, P.MONTH_START, P.MONTH_END)
    d = BT.dedup_cohort(d, [M, "customer_id"], ["as_of_date", "row_id"])
    d = BT.filter_min_records(d, [M], P.MIN_RECORDS)
    return BT.dropna_subset(d, ["pd_12m", "y_event_12m"]).select(*_COHORT_COLS)


@query("clip_prob", S.with_(*PREP) + f"SELECT row_id, as_of_month, {R('p')} AS p, y FROM cb")
def q_clip_prob(spark, sf):
    return prepared(spark, sf).select("row_id", M, F.col("_p").alias("p"), F.col("_y").alias("y"))


# ---------------------------------------------------------------------------
# rank metrics
# ---------------------------------------------------------------------------
@query("auc", S.with_(*PREP, rank_sql()) + f"SELECT as_of_month, {R('auc')} AS auc FROM rk")
def q_auc(spark, sf):
    return ranking.auc(prepared(spark, sf), [M], "_p", "_y")


@query("ks", S.with_(*PREP, rank_sql()) + f"SELECT as_of_month, {R('ks')} AS ks FROM rk")
def q_ks(spark, sf):
    return ranking.ks(prepared(spark, sf), [M], "_p", "_y")


@query("pr_auc", S.with_(*PREP, rank_sql()) + f"SELECT as_of_month, {R('pr_auc')} AS pr_auc FROM rk")
def q_pr_auc(spark, sf):
    return ranking.pr_auc(prepared(spark, sf), [M], "_p", "_y")


@query("brier", S.with_(*PREP) + f"SELECT as_of_month, {R('AVG(POW(y - p, 2))')} AS brier "
       "FROM cb GROUP BY as_of_month")
def q_brier(spark, sf):
    return ranking.brier(prepared(spark, sf), [M], "_p", "_y")


@query("lift_at_k", S.with_(*PREP, lift_sql())
       + f"SELECT as_of_month, {R('lift_10pct')} AS lift_10pct, {R('lift_20pct')} AS lift_20pct FROM lf")
def q_lift_at_k(spark, sf):
    return ranking.lift_wide(prepared(spark, sf), [M], "_p", "_y", (0.1, 0.2), "row_id")


_EVAL_COLS = [f"{n}_{m}" for n in ("amber", "red") for m in ("alert_rate", "precision", "recall", "alerts")]


@query("threshold_eval", S.with_(*PREP, eval_sql())
       + f"SELECT as_of_month, {rsel(_EVAL_COLS, set(_EVAL_COLS) - {'amber_alerts', 'red_alerts'})} FROM te")
def q_threshold_eval(spark, sf):
    return ranking.threshold_eval(prepared(spark, sf), [M], "_p", "_y",
                                  {"amber": P.AMBER, "red": P.RED})


_CUTS_SQL = "(VALUES " + ", ".join(f"({c})" for c in P.sweep_cuts()) + ") AS cuts(cut)"
_SWEEP_SQL = f"""sw AS (
  SELECT as_of_month, CAST(cut AS DOUBLE) AS cut,
    CAST(COUNT_IF(p >= cut) AS DOUBLE) / COUNT(*) AS alert_rate,
    CASE WHEN COUNT_IF(p >= cut) > 0 THEN CAST(SUM(CASE WHEN p >= cut THEN y ELSE 0 END) AS DOUBLE) / COUNT_IF(p >= cut) END AS precision,
    CASE WHEN SUM(y) > 0 THEN CAST(SUM(CASE WHEN p >= cut THEN y ELSE 0 END) AS DOUBLE) / SUM(y) END AS recall,
    CAST(COUNT_IF(p >= cut) AS BIGINT) AS alerts
  FROM cb CROSS JOIN {_CUTS_SQL} GROUP BY as_of_month, cut)"""
_SWEEP_COLS = ["as_of_month", "cut", "alert_rate", "precision", "recall", "alerts"]
_SWEEP_D = {"cut", "alert_rate", "precision", "recall"}
SWEEP_SQL = S.with_(*PREP, _SWEEP_SQL) + f"SELECT {rsel(_SWEEP_COLS, _SWEEP_D)} FROM sw"


@query("threshold_sweep", SWEEP_SQL)
def q_threshold_sweep(spark, sf):
    return ranking.threshold_sweep(prepared(spark, sf), [M], "_p", "_y", P.sweep_cuts())


@query("join_cut_theta", SWEEP_SQL)
def q_join_cut_theta(spark, sf):
    return ranking.join_cut_theta(prepared(spark, sf), [M], "_p", "_y", P.sweep_cuts())


# ---------------------------------------------------------------------------
# calibration
# ---------------------------------------------------------------------------
_QCUT = calib.qcut_probs(P.N_BINS)


def decile_sql(keys: str = "as_of_month", src: str = "cb", name: str = "dc") -> str:
    return S.np_edges_sql(f"{name}_q", src, keys, "p", _QCUT) + f""",
{name}_e AS (SELECT {keys}, list_sort(list_distinct(e)) AS e FROM {name}_q),
{name}_b AS (SELECT s.*, len(list_filter(e[2:len(e) - 1], lambda x: x < s.p)) AS bin
  FROM {src} s JOIN {name}_e USING ({keys})),
{name} AS (SELECT {keys}, CAST(DENSE_RANK() OVER (PARTITION BY {keys} ORDER BY bin) AS INTEGER) AS decile,
  COUNT(*) AS count, AVG(p) AS pd_avg, AVG(CAST(y AS DOUBLE)) AS odr,
  ABS(AVG(p) - AVG(CAST(y AS DOUBLE))) * 1e4 AS abs_err_bp
  FROM {name}_b GROUP BY {keys}, bin)"""


_DEC_COLS = ["as_of_month", "decile", "count", "pd_avg", "odr", "abs_err_bp"]
DECILE_SQL = S.with_(*PREP, decile_sql()) + f"SELECT {rsel(_DEC_COLS, {'pd_avg', 'odr', 'abs_err_bp'}, MEANS)} FROM dc"


@query("decile_calibration", DECILE_SQL, digits=MEANS)
def q_decile_calibration(spark, sf):
    return calib.decile_calibration(prepared(spark, sf), [M], "_p", "_y", P.N_BINS)


@query("reliability_curve", S.with_(*PREP, S.np_edges_sql("re", "cb", "as_of_month", "p", _QCUT)) + f""",
rb AS (SELECT cb.*, len(list_filter(e[2:{P.N_BINS}], lambda x: x < cb.p)) AS bin FROM cb JOIN re USING (as_of_month))
SELECT as_of_month, CAST(bin AS INTEGER) AS bin, {R('AVG(p)', MEANS)} AS prob_pred, {R('AVG(CAST(y AS DOUBLE))', MEANS)} AS prob_true
FROM rb GROUP BY as_of_month, bin""", digits=MEANS)
def q_reliability_curve(spark, sf):
    return calib.reliability_curve(prepared(spark, sf), [M], "_p", "_y", P.N_BINS)


@query("pr_curve_points", S.with_(*PREP, rank_sql()) + f""", mp AS (
  SELECT as_of_month, MIN(p) AS minpos FROM cb WHERE y = 1 GROUP BY 1)
SELECT c.as_of_month, {R('c.p')} AS threshold,
  {R('CAST(tot_pos - cp + np AS DOUBLE) / ((tot_pos - cp + np) + (tot_neg - cn + nn))')} AS precision,
  {R('CAST(tot_pos - cp + np AS DOUBLE) / tot_pos')} AS recall
FROM rk_cum c JOIN rk_tot t ON c.as_of_month = t.as_of_month JOIN mp ON c.as_of_month = mp.as_of_month
WHERE c.p >= mp.minpos""")
def q_pr_curve_points(spark, sf):
    return ranking.pr_curve_points(prepared(spark, sf), [M], "_p", "_y")


# ---------------------------------------------------------------------------
# cohort / segment / monthly
# ---------------------------------------------------------------------------
_CM_COLS = ["as_of_month"] + _METRIC_COLS


@query("cohort_metrics", S.with_(*PREP, *cohort_sql()) + f"SELECT {rsel(_CM_COLS, _METRIC_D)} FROM cm")
def q_cohort_metrics(spark, sf):
    return BT.cohort_metrics(prepared(spark, sf), [M], bparams())


_ROLL = ["auc_roll12", "ks_roll12", "brier_roll12", "pr_auc_roll12"]
_MM_COLS = ["as_of_month", "pd_col", "y_col", "amber", "red"] + _METRIC_COLS + _ROLL
_MM_D = _METRIC_D | set(_ROLL) | {"amber", "red"}
_ROLL_SQL = ", ".join(
    f"CASE WHEN COUNT({c}) OVER w >= 3 THEN AVG({c}) OVER w END AS {c}_roll12"
    for c in ("auc", "ks", "brier", "pr_auc"))
MM_CTE = f"""mm AS (
  SELECT as_of_month, 'pd_12m' AS pd_col, 'y_event_12m' AS y_col, CAST({P.AMBER} AS DOUBLE) AS amber,
    CAST({P.RED} AS DOUBLE) AS red, {', '.join(_METRIC_COLS)}, n_pos, n_neg, {_ROLL_SQL}
  FROM cm WINDOW w AS (ORDER BY as_of_month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))"""
BT_CTES = (*PREP, *cohort_sql(), MM_CTE)
MONTHLY_SQL = S.with_(*BT_CTES) + f"SELECT {rsel(_MM_COLS, _MM_D)} FROM mm"


@query("metrics_roll12", MONTHLY_SQL)
def q_metrics_roll12(spark, sf):
    return BT.monthly_metrics(prepared(spark, sf), bparams())


@query("backtest_monthly", MONTHLY_SQL)
def q_backtest_monthly(spark, sf):
    """Whole monthly backtest; the metrics table (calibration / sweep / segments
    are the ``decile_calibration``, ``threshold_sweep``, ``segment_metrics`` keys)."""
    return _backtest(spark, sf)["metrics"]


@query("backtest_update", MONTHLY_SQL)
def q_backtest_update(spark, sf):
    """The monthly metrics kept up to date over three batches: the cohorts before 2000, those from 2000 on, and late
    rows (a tenth of the customers) of all months."""
    rows = materialize(A.backtest_cohorts(spark, sf))
    late = F.col("customer_id") % 10 == 3
    base, p = shared_path(spark, "backtest"), bparams()
    recent = F.col("as_of_date") >= F.lit("2000-01-01").cast("date")
    for part in (~late & ~recent, ~late & recent, late):
        out = BT.update_backtest(rows.where(part), base, p)
    return out


def _backtest(spark, sf):
    return BT.backtest_monthly(A.backtest_cohorts(spark, sf), bparams(segment_col="sector", segment_min_records=SEGMENT_MIN))


@query("backtest_calibration", ORACLE["decile_calibration"], digits=MEANS)
def q_backtest_calibration(spark, sf):
    """The monthly backtest's calibration deciles."""
    return _backtest(spark, sf)["calibration"]


@query("backtest_sweep", ORACLE["threshold_sweep"])
def q_backtest_sweep(spark, sf):
    """The monthly backtest's threshold sweep."""
    return _backtest(spark, sf)["sweep"]


_SEG = "as_of_month, segment"
_SEG_COLS = ["as_of_month", "segment_col", "segment"] + _METRIC_COLS


def _segment_sql(least: int) -> str:
    return S.with_(*PREP, f"""sg0 AS (SELECT *, sector AS segment FROM cb WHERE sector IS NOT NULL),
sg AS (SELECT sg0.* FROM sg0 JOIN (SELECT as_of_month AS km, segment AS ks FROM sg0 GROUP BY 1, 2
       HAVING COUNT(*) >= {least}) k ON sg0.as_of_month = k.km AND sg0.segment = k.ks)""",
                   *cohort_sql(_SEG, "sg", "s_")) \
        + f"SELECT as_of_month, 'sector' AS segment_col, segment, {rsel(_METRIC_COLS, _METRIC_D, MEANS)} FROM s_cm"


@query("backtest_segments", _segment_sql(SEGMENT_MIN), digits=MEANS)
def q_backtest_segments(spark, sf):
    """The monthly backtest's segment table."""
    return _backtest(spark, sf)["segments"]


@query("segment_metrics", _segment_sql(SEGMENT_MIN), digits=MEANS)
def q_segment_metrics(spark, sf):
    """Metrics by month x sector (segment size floor 30)."""
    p = bparams(segment_min_records=SEGMENT_MIN)
    d = prepared(spark, sf)
    return BT.segment_metrics(d, p, "sector")
