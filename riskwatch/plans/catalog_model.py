"""Registered model queries. Training and what it feeds have no
SQL oracle (they are tested against plain versions); split, weights, isotonic steps,
quota thresholds, scores, tiers and actions are SQL-checked."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expr import ACTIONS, action_map, ews_score, tier_assign
from ..functions.expr import stable_double_sql as R
from ..operators import boost, isotonic
from ..operators import model as MD
from ..session import materialize, shared_path
from ..sources import adapters as A
from . import catalog_features as CF
from . import params as P
from . import sql_adapters as S
from .registry import query

LABEL = "event_h12m"


def mparams() -> MD.ModelParams:
    return MD.ModelParams(label=LABEL, seed=P.SEED)


def split_labelled(spark, sf):
    f = materialize(CF.build_features(spark, sf), "features")  # read for the hash ranges and the rows
    return materialize(MD.split_stratified(f, LABEL, P.TEST_SIZE, P.SEED))


SPLIT_SQL = (*CF.FEATURE_CTES, f"""lab AS (SELECT * FROM zz WHERE event_h12m IS NOT NULL),
sp AS (SELECT z.*, ROW_NUMBER() OVER (PARTITION BY CAST(event_h12m AS BIGINT)
           ORDER BY ((customer_id % 4294967296) * 1103515245 + {P.SEED * 40503}) % 4294967296, customer_id) AS rk,
         COUNT(*) OVER (PARTITION BY CAST(event_h12m AS BIGINT)) AS n_s FROM lab z),
spl AS (SELECT * EXCLUDE (rk, n_s), rk <= ROUND(n_s * {P.TEST_SIZE}) AS is_test FROM sp)""")


@query("split_stratified", S.with_(*SPLIT_SQL) + "SELECT customer_id, event_h12m, is_test FROM spl")
def q_split_stratified(spark, sf):
    """Exact stratified 80/20 split of the labelled feature rows."""
    return split_labelled(spark, sf).select("customer_id", LABEL, "is_test")


@query("class_weight", S.with_(*SPLIT_SQL) + f"""SELECT {R('AVG(CAST(event_h12m AS DOUBLE))')} AS pos_rate,
  {R('(1 - AVG(CAST(event_h12m AS DOUBLE))) / GREATEST(AVG(CAST(event_h12m AS DOUBLE)), 1e-6)')} AS pos_weight
FROM spl WHERE NOT is_test""")
def q_class_weight(spark, sf):
    s = split_labelled(spark, sf)
    return MD.class_weight(s.filter(~F.col("is_test")), LABEL)


_TRAINED: dict[tuple, tuple] = {}


def _stamps(spark, sf):
    """Size and time of every file under the input folder's tables that the features read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for name in ("customer", "nation", "orders", "lineitem", "events"):
        path = jvm.org.apache.hadoop.fs.Path(f"{sf}/{name}.parquet")
        fs = path.getFileSystem(conf)
        out += [(st.getPath().toString(), st.getLen(), st.getModificationTime()) for st in fs.listStatus(path)] if fs.exists(path) else []
    return tuple(out)


def _trained_on(spark, sf):
    """The folder of a training run on this input and the features of all customers, both made once a session and state
    of the input's files. The features are written, as splits, folds and batch scoring read them again and again."""
    key = (spark.sparkContext.applicationId, sf, _stamps(spark, sf))
    if key not in _TRAINED:
        features = materialize(CF.build_features(spark, sf), "features")
        _TRAINED[key] = MD.train_and_calibrate(features, shared_path(spark, "model"), mparams(), P.TEST_SIZE), features
    return _TRAINED[key]


def _trained(spark, sf):
    return _trained_on(spark, sf)[0]


def _loaded(spark, sf):
    path = _trained(spark, sf)
    return spark.read.parquet(f"{path}/split"), MD.load_model(spark, path)


@query("train_classifier")
def q_train_classifier(spark, sf):
    """Leaf-wise boosted trees on the train split; each feature's share of the gain."""
    return spark.createDataFrame(boost.importances(_loaded(spark, sf)[1]), "feature string, importance double")


@query("topk_importance")
def q_topk_importance(spark, sf):
    """Top 5 features by tree importance."""
    return q_train_classifier(spark, sf).orderBy(F.col("importance").desc(), "feature").limit(5)


@query("score_raw")
def q_score_raw(spark, sf):
    s, m = _loaded(spark, sf)
    return MD.score_raw(m, s, ["customer_id", LABEL, "is_test"]).drop("margin")


def _recalibrated(spark, sf):
    s, m = _loaded(spark, sf)
    raw = materialize(MD.score_raw(m, s, ["customer_id", LABEL]).drop("margin"), "raw")
    return MD.calibrate_isotonic(raw, "score_raw", LABEL, P.CALIBRATED_RED, P.CALIBRATED_AMBER)


@query("calibrate_isotonic")
def q_calibrate_isotonic(spark, sf):
    """Isotonic re-calibration of the raw scores: probability, EWS score and tier of every labelled row."""
    return _recalibrated(spark, sf)[1]


@query("calibrate_summary")
def q_calibrate_summary(spark, sf):
    """Positives, the few-positives flag and the metrics of the re-calibration."""
    return _recalibrated(spark, sf)[2]


@query("calibrate_cv")
def q_calibrate_cv(spark, sf):
    """Mean of the five folds' calibrated probabilities."""
    return spark.read.parquet(f"{_trained(spark, sf)}/scores").select("customer_id", LABEL, "is_test", "prob_calibrated")


@query("model_scores")
def q_model_scores(spark, sf):
    """The training run's output: ids, calibrated probability, capacity tier, label and split of every row."""
    return spark.read.parquet(f"{_trained(spark, sf)}/scores")


@query("model_holdout")
def q_model_holdout(spark, sf):
    """AUC, PR-AUC, KS and Brier of the test split, and the quota thresholds of the run."""
    path = _trained(spark, sf)
    return spark.read.parquet(f"{path}/metrics").crossJoin(F.broadcast(spark.read.parquet(f"{path}/thresholds")))


@query("model_score_batch")
def q_model_score_batch(spark, sf):
    """Every customer's features scored with the saved, calibrated model and absolute cutoffs."""
    path, features = _trained_on(spark, sf)
    return MD.score_features(path, features, P.CALIBRATED_RED, P.CALIBRATED_AMBER)


def _explained(spark, sf):
    s, m = _loaded(spark, sf)
    return boost.contributions(s, m, ["customer_id"]), m.features


@query("explain_global")
def q_explain_global(spark, sf):
    """Mean |contribution to the margin| per feature, descending."""
    c, feats = _explained(spark, sf)
    return MD.explain_global(c, feats).orderBy(F.col("mean_abs_contribution").desc(), "feature")


@query("explain_topk")
def q_explain_topk(spark, sf):
    """Top-5 drivers per customer: feature, contribution, value."""
    c, feats = _explained(spark, sf)
    return MD.explain_topk(c, feats, ["customer_id"], 5)


# ---------------------------------------------------------------------------
# scores on a scored population (cohort PDs): SQL-checkable
# ---------------------------------------------------------------------------
def scored(spark, sf):
    return A.backtest_cohorts(spark, sf).select("row_id", "customer_id", F.col("pd_12m").alias("p"))


_THR = {"red": P.RED, "amber": P.AMBER}
_TIER = f"CASE WHEN p IS NULL THEN NULL WHEN p >= {P.RED} THEN 'Red' WHEN p >= {P.AMBER} THEN 'Amber' ELSE 'Green' END"
_ACT = "CASE tier " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ACTIONS.items()) + " END"


@query("isotonic_steps", S.with_(S.COHORTS, """sc AS MATERIALIZED (
  SELECT pd_12m AS s, SUM(CASE WHEN y_event_12m = 1 THEN 1 ELSE 0 END) AS pos, COUNT(*) AS n FROM cohorts
  WHERE pd_12m IS NOT NULL AND y_event_12m IS NOT NULL GROUP BY 1)""", """cu AS MATERIALIZED (
  SELECT *, ROW_NUMBER() OVER (ORDER BY s) AS i, SUM(pos) OVER (ORDER BY s) AS cp, SUM(n) OVER (ORDER BY s) AS cn FROM sc)""",
                              """pr AS (
  SELECT a.i AS j, b.i AS i, CAST(b.cp - a.cp + a.pos AS DOUBLE) / CAST(b.cn - a.cn + a.n AS DOUBLE) AS mean
  FROM cu a JOIN cu b ON a.i <= b.i)""", """mn AS (
  SELECT i, MIN(mean) OVER (PARTITION BY j ORDER BY i DESC) AS m FROM pr)""", """vl AS (
  SELECT i, MAX(m) AS v FROM mn GROUP BY i)""") + f"""SELECT {R('MIN(s)')} AS lo, {R('MAX(s)')} AS hi,
  CAST(SUM(pos) AS BIGINT) AS pos, CAST(SUM(n) AS BIGINT) AS n, {R('v')} AS value FROM cu JOIN vl USING (i) GROUP BY v""")
def q_isotonic_steps(spark, sf):
    """The steps of an isotonic calibration of the cohorts' probabilities. The SQL takes, for each score, the
    largest over earlier starts of the smallest mean over later ends."""
    c = A.backtest_cohorts(spark, sf).select("pd_12m", "y_event_12m")
    return isotonic.fit(c, "pd_12m", "y_event_12m").drop("key")


@query("ews_score", S.with_(S.COHORTS) + f"SELECT row_id, {R('round_even(100.0 * (1.0 - pd_12m), 2)')} AS score_ews FROM cohorts")
def q_ews_score(spark, sf):
    return scored(spark, sf).select("row_id", ews_score("p").alias("score_ews"))


@query("tier_assign", S.with_(S.COHORTS) + f"SELECT row_id, {_TIER.replace('p ', 'pd_12m ').replace('p IS', 'pd_12m IS')} AS tier FROM cohorts")
def q_tier_assign(spark, sf):
    return scored(spark, sf).select("row_id", tier_assign("p", P.RED, P.AMBER).alias("tier"))


@query("action_map", S.with_(S.COHORTS) + f"""SELECT row_id, tier, {_ACT} AS action FROM (
  SELECT row_id, {_TIER.replace('p ', 'pd_12m ').replace('p IS', 'pd_12m IS')} AS tier FROM cohorts)""")
def q_action_map(spark, sf):
    t = scored(spark, sf).select("row_id", tier_assign("p", P.RED, P.AMBER).alias("tier"))
    return t.select("row_id", "tier", action_map("tier").alias("action"))


@query("score_batch", S.with_(S.COHORTS) + f"""SELECT row_id, {R('p')} AS prob_default_12m_calibrated,
  {R('round_even(100.0 * (1.0 - p), 2)')} AS score_ews, tier, {_ACT} AS action FROM (
  SELECT row_id, pd_12m AS p, {_TIER.replace('p ', 'pd_12m ').replace('p IS', 'pd_12m IS')} AS tier FROM cohorts)""")
def q_score_batch(spark, sf):
    """Calibrated PD -> EWS score, tier and action with absolute cutoffs."""
    return MD.score_batch(scored(spark, sf), "p", P.RED, P.AMBER, id_col="row_id")


@query("thresholds_quota", S.with_(S.COHORTS) + f"""SELECT {R('QUANTILE_CONT(pd_12m, 0.95)')} AS red,
  {R('QUANTILE_CONT(pd_12m, 0.85)')} AS amber FROM cohorts""")
def q_thresholds_quota(spark, sf):
    """Capacity cutoffs: red = top 5 %, amber = next 10 %."""
    return MD.thresholds_quota(scored(spark, sf), "p", 0.05, 0.10)


@query("sample_rows", S.with_(S.COHORTS) + f"""SELECT row_id, customer_id, {R('pd_12m')} AS pd_12m FROM cohorts
ORDER BY ((row_id % 4294967296) * 1103515245 + {P.SEED * 40503}) % 4294967296, row_id LIMIT 100""")
def q_sample_rows(spark, sf):
    """Seeded sample of 100 rows (the sampling operator; ids stay attached)."""
    c = A.backtest_cohorts(spark, sf).select("row_id", "customer_id", "pd_12m")
    return MD.sample_rows(c, 100, P.SEED, id_col="row_id")
