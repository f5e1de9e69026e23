"""Default-probability model: split, class weights, boosted trees, isotonic
calibration (single and k-fold), quota thresholds, scoring, explanations.

Trees grow leaf by leaf from gradient sums that Spark counts (``boost``); the full
model and the models of the folds grow in the same jobs. Calibration pools counts by
score, range by range (``isotonic``). ``train_and_calibrate`` is the whole chain, from labelled
features to a folder with everything that scoring, monitoring and explanations load.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expr import action_map, clip_prob, ews_score, id_hash, tier_assign
from ..functions.windows import prefix_sums
from ..session import materialize
from . import boost, isotonic, ranking
from .robust import exact_quantiles

ROWS_PER_TASK = 1_000_000
"""Rows of a model that one task holds, at some 200 bytes a row (reckoned, not measured)."""
FEW_POSITIVES = 100
ID_CANDIDATES = ("customer_id", "sector_code", "size_bucket")


def select_features(df: DataFrame, target: str, min_z: int = 5,
                    drop=("customer_id", "sector_code", "size_bucket")) -> list[str]:
    """Numeric columns minus ids / target; the z-scored ones when at least ``min_z``."""
    num = {"double", "float", "int", "bigint", "smallint", "tinyint"}
    cols = [c for c, t in df.dtypes if (t in num or t.startswith("decimal"))
            and c not in set(drop) | {target, "is_test", "fold"}]
    zs = [c for c in cols if c.endswith("__zs_sector_size")]
    return zs if len(zs) >= min_z else cols


def select_ids(df: DataFrame) -> list[str]:
    return [c for c in ID_CANDIDATES if c in df.columns]


def split_stratified(df: DataFrame, label: str, test_size: float = 0.2, seed: int = 42,
                     id_col: str = "customer_id", drop_null_labels: bool = True) -> DataFrame:
    """Exact, deterministic stratified split: within each label value the rows
    with the ``round(n * test_size)`` smallest id hashes are ``is_test``.

    The ids' hash ranges are counted. All rows of a range before the one that the share of a class ends in are
    ``is_test``, none after it; only the rows of that one range are ranked, so that no row moves but these. ``df`` is
    read three times, so it should be materialized. Rows without a hash (a null integer id) are left out.
    """
    d = df.dropna(subset=[label]) if drop_null_labels else df
    d = d.withColumn("_stratum", F.coalesce(F.col(label).cast("long"), F.lit(-1))).withColumn("_h", id_hash(df, id_col, seed))
    d = d.withColumn("_b", F.shiftright("_h", 22)).where(F.col("_b").isNotNull())
    ranges = d.groupBy("_stratum", "_b").agg(F.count(F.lit(1)).alias("_n"))
    of = Window.partitionBy("_stratum")
    ranges = ranges.select("_stratum", "_b", "_n", F.sum("_n").over(of.orderBy("_b")).alias("_upto"),
                           F.round(F.sum("_n").over(of) * F.lit(float(test_size))).alias("_test"))
    end = F.struct(F.col("_b").alias("at"), (F.col("_test") - (F.col("_upto") - F.col("_n"))).alias("take"))
    ends = ranges.groupBy("_stratum").agg(F.min(F.when(F.col("_upto") >= F.col("_test"), end)).alias("_end"))
    d = d.join(F.broadcast(materialize(ends, "ends")), "_stratum")  # one row a label value
    last = F.coalesce(F.col("_b") == F.col("_end")["at"], F.lit(False))
    rank = F.row_number().over(of.orderBy("_h", id_col))
    sure = d.where(~last).select(*df.columns, F.coalesce(F.col("_b") < F.col("_end")["at"], F.lit(True)).alias("is_test"))
    return sure.unionByName(d.where(last).select(*df.columns, (rank <= F.col("_end")["take"]).alias("is_test")))


def _ranked(df: DataFrame, id_col: str, seed: int) -> DataFrame:
    """``_rank`` (from 1) inside ``_stratum`` by (id hash, id): hash ranges are the buckets of the prefix sum."""
    d = df.withColumn("_h", id_hash(df, id_col, seed)).withColumn("_one", F.lit(1))
    ranked = prefix_sums(d, ["_stratum"], "_h", ["_one"], prefix="_rank", tiebreak=[id_col],
                         bucket=F.shiftright("_h", 22))
    return ranked.withColumnRenamed("_rank_one", "_rank").drop("_h", "_one")


def class_weight(df: DataFrame, label: str) -> DataFrame:
    """One row: positive share and the positive-class weight (1 - pi) / max(pi, 1e-6)."""
    return df.agg(F.avg(F.col(label).cast("double")).alias("pos_rate")).select(
        "pos_rate", ((1 - F.col("pos_rate")) / F.greatest(F.col("pos_rate"), F.lit(1e-6)))
        .alias("pos_weight"))


@dataclass
class ModelParams(boost.BoostParams):
    label: str = "event_h12m"


def train_classifier(train: DataFrame, features: Sequence[str], p: ModelParams, fold: str | None = None,
                     folds: int = 0) -> boost.Ensemble:
    """Trees on all rows and, with ``folds``, on the rows of all folds but one. Positives weigh (1 - rate) / rate."""
    return boost.train(train, features, p.label, p, fold, folds, ROWS_PER_TASK)


def save_model(model: boost.Ensemble, path: str, spark: SparkSession) -> None:
    boost.save(model, path, spark)


def load_model(spark: SparkSession, path: str) -> boost.Ensemble:
    return boost.load(spark, path)


def score_raw(model: boost.Ensemble, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The kept columns, ``margin`` (log odds of the full model) and its uncalibrated probability ``score_raw``."""
    margin = F.col("margins")[0]
    return boost.margins(df, model, keep).select(*keep, margin.alias("margin"), boost.probability(margin).alias("score_raw"))


def calibrate_isotonic(scored: DataFrame, score_col: str, label: str, red: float, amber: float,
                       bounds=(1e-6, 1 - 1e-6)) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(steps, mapping, summary) of a re-calibration of rows with a score and a label.

    The mapping has ``prob_calibrated``, the EWS score and the tier by absolute cutoffs for every row. The summary is
    one row: positives, whether these are too few to trust, and auc, pr_auc and brier of the new probabilities.
    """
    d = scored.dropna(subset=[score_col, label])
    steps = isotonic.fit(d, score_col, label)
    out = isotonic.interpolate(d, steps, score_col, "prob_calibrated", bounds)
    out = out.withColumn("score_ews", ews_score("prob_calibrated")).withColumn("tier", tier_assign("prob_calibrated", red, amber))
    positives = steps.agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"))
    positives = positives.withColumn("few_positives", F.col("positives") < FEW_POSITIVES)
    return steps, out, positives.crossJoin(F.broadcast(metrics(out, "prob_calibrated", label).select("auc", "pr_auc", "brier")))


def metrics(scored: DataFrame, score: str, label: str) -> DataFrame:
    """One row: auc, pr_auc, ks, brier."""
    m = ranking.rank_metrics(scored, [], score, label)
    return m.crossJoin(F.broadcast(ranking.brier(scored, [], score, label))).select("auc", "pr_auc", "ks", "brier")


def assign_folds(df: DataFrame, label: str, k: int = 5, seed: int = 42,
                 id_col: str = "customer_id") -> DataFrame:
    """Stratified fold id 0..k-1: rank inside each class by id hash, modulo k."""
    d = _ranked(df.withColumn("_stratum", F.col(label).cast("long")), id_col, seed + 1)
    return d.withColumn("fold", F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")).drop("_stratum", "_rank")


def calibrate_cv(model: boost.Ensemble, train: DataFrame, label: str, fold: str = "fold") -> DataFrame:
    """The steps of each fold, keyed by it: the label on the score of the model that has not seen the fold.

    All folds are scored in one pass and pooled in the same tasks.
    """
    scored = boost.margins(train, model, [label, fold])
    own = F.element_at("margins", F.col(fold).cast("int") + 2)  # the full model comes first
    return isotonic.fit(scored.select(label, fold, boost.probability(own).alias("_raw")), "_raw", label, fold)


def predict_cv(model: boost.Ensemble, steps: DataFrame, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The kept columns and ``prob_calibrated``, the mean of the folds' calibrated probabilities."""
    k = len(model.models) - 1
    d = boost.margins(df, model, keep).select(*keep, *[boost.probability(F.col("margins")[i + 1]).alias(f"_r{i}") for i in range(k)])
    for i in range(k):
        d = isotonic.interpolate(d, steps.where(F.col("key") == i), f"_r{i}", f"_c{i}", (0.0, 1.0))
    return d.select(*keep, clip_prob(sum((F.col(f"_c{i}") for i in range(1, k)), F.col("_c0")) / float(k)).alias("prob_calibrated"))


def train_and_calibrate(df: DataFrame, path: str, p: ModelParams, test_size: float = 0.2, folds: int = 5,
                        red_pct: float = 0.05, amber_pct: float = 0.10, id_col: str = "customer_id") -> str:
    """The whole chain; returns ``path``, under which there are then

    ``split`` (features, ``is_test``, ``fold``), the model, ``steps`` (its calibration), ``scores`` (ids, calibrated
    probability, tier by capacity, label, ``is_test``), ``thresholds`` (red, amber) and ``metrics`` (of the test rows).
    """
    spark, features = df.sparkSession, select_features(df, p.label)
    split = split_stratified(df, p.label, test_size, p.seed, id_col)
    fold = assign_folds(split.where("not is_test"), p.label, folds, p.seed, id_col)
    split.where("is_test").withColumn("fold", F.lit(None).cast("int")).unionByName(fold).write.parquet(f"{path}/split")
    split = spark.read.parquet(f"{path}/split")
    train = split.where("not is_test")
    model = train_classifier(train, features, p, "fold", folds)
    save_model(model, path, spark)
    calibrate_cv(model, train, p.label).write.parquet(f"{path}/steps")
    steps = spark.read.parquet(f"{path}/steps")
    keep = [*select_ids(split), p.label, "is_test"]
    predict_cv(model, steps, split, keep).write.parquet(f"{path}/scored")
    scored = spark.read.parquet(f"{path}/scored")
    thresholds_quota(scored, "prob_calibrated", red_pct, amber_pct).coalesce(1).write.parquet(f"{path}/thresholds")
    red, amber = spark.read.parquet(f"{path}/thresholds").select("red", "amber").first()
    tier = tier_assign("prob_calibrated", red, amber) if red is not None else F.lit(None).cast("string")
    scored.withColumn("tier", tier).write.parquet(f"{path}/scores")
    scores = spark.read.parquet(f"{path}/scores")
    metrics(scores.where("is_test"), "prob_calibrated", p.label).coalesce(1).write.parquet(f"{path}/metrics")
    return path


def score_features(path: str, df: DataFrame, red: float, amber: float, id_col: str = "customer_id") -> DataFrame:
    """Batch scoring: features to calibrated probability, EWS score, tier and action, with what a training run wrote."""
    spark = df.sparkSession
    p = predict_cv(load_model(spark, path), spark.read.parquet(f"{path}/steps"), df, [id_col])
    return score_batch(p, "prob_calibrated", red, amber, id_col)


def thresholds_quota(scored: DataFrame, prob_col: str = "prob_calibrated", red_pct: float = 0.05,
                     amber_pct: float = 0.10) -> DataFrame:
    """One row: red = q(1 - red_pct), amber = q(1 - red_pct - amber_pct)."""
    q = exact_quantiles(scored, [prob_col], [1 - red_pct, 1 - red_pct - amber_pct], prefix="_q_")
    return q.select(F.col("_q_" + prob_col)[0].alias("red"), F.col("_q_" + prob_col)[1].alias("amber"))


def score_batch(scored: DataFrame, prob_col: str, red: float, amber: float,
                id_col: str = "customer_id") -> DataFrame:
    """customer_id, calibrated PD, EWS score (100 (1 - p), half-even), tier, action."""
    p = F.col(prob_col)
    return scored.select(
        id_col, p.alias("prob_default_12m_calibrated"), ews_score(p).alias("score_ews"),
        tier_assign(p, red, amber).alias("tier"),
        action_map(tier_assign(p, red, amber)).alias("action"))


# ---------------------------------------------------------------------------
# explanation: ``boost.contributions`` of the full model's trees
# ---------------------------------------------------------------------------
def explain_global(contrib: DataFrame, features: Sequence[str]) -> DataFrame:
    """feature, mean_abs_contribution (one aggregation, then unpivot), descending."""
    row = contrib.agg(*[F.avg(F.abs(F.col(f"c__{c}"))).alias(c) for c in features])
    packed = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("mean_abs_contribution"))
                       for c in features])
    return row.select(F.inline(packed))


def explain_topk(contrib: DataFrame, features: Sequence[str], keep: Sequence[str], k: int = 5) -> DataFrame:
    """Top-k drivers per row by |contribution|: feat1..k, contrib1..k, value1..k."""
    items = F.array(*[F.struct(F.abs(F.col(f"c__{c}")).alias("a"), F.lit(c).alias("f"),
                               F.col(f"c__{c}").alias("s"), F.col(f"v__{c}").alias("v"))
                      for c in features])
    top = F.slice(F.reverse(F.array_sort(items)), 1, k)
    d = contrib.select(*keep, top.alias("_t"))
    cols = []
    for i in range(k):
        e = F.col("_t")[i]
        cols += [e["f"].alias(f"feat{i + 1}"), e["s"].alias(f"contrib{i + 1}"), e["v"].alias(f"value{i + 1}")]
    return d.select(*keep, *cols)


def sample_rows(df: DataFrame, n: int, seed: int = 42, id_col: str = "customer_id") -> DataFrame:
    """Seeded sample of ``n`` rows (ids stay attached): the n smallest id hashes."""
    return df.withColumn("_h", id_hash(df, id_col, seed)).orderBy("_h", id_col).limit(n).drop("_h")
