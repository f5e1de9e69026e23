"""Registered drift / data-quality queries and SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expr import stable_double_sql as R
from ..operators import drift as D
from ..operators import features as FE
from ..operators.calib import percent_probs
from ..operators.model import split_stratified
from ..session import materialize
from ..sources import adapters as A
from . import catalog_features as CF
from . import params as P
from . import sql_adapters as S
from .registry import query

_NUM = ("pd_12m", "ead", "lgd")
_CAT = ("sector", "grade")
_FEATS = list(FE.MODEL_COLUMNS)


def _long_sql(src: str, period: str, cols, cast: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {period} AS m, '{c}' AS series, CAST({c} AS {cast}) AS value FROM {src}" for c in cols)


_PSI_BASE = [S.COHORTS, f"""d AS (SELECT *, last_day(as_of_date) AS m0 FROM cohorts),
b AS (SELECT MIN(m0) AS bm FROM d),
months AS (SELECT DISTINCT m0 AS m FROM d),
num AS ({_long_sql('d', 'm0', _NUM, 'DOUBLE')}),
cat AS ({_long_sql('d', 'm0', _CAT, 'VARCHAR')}),
nbase AS (SELECT * FROM num WHERE m = (SELECT bm FROM b))""",
             S.np_edges_sql("ed0", "nbase", "series", "value", percent_probs(10)),
             f"""ed AS (SELECT series, list_sort(list_distinct(e)) AS e FROM ed0),
nb AS (SELECT n.series, n.m, len(list_filter(e[2:len(e) - 1], lambda x: x <= n.value)) AS bin
       FROM num n JOIN ed USING (series) WHERE n.value IS NOT NULL),
ncnt AS (SELECT series, m, bin, COUNT(*) AS c FROM nb GROUP BY 1, 2, 3),
ntot AS (SELECT series, m, SUM(c) AS tot FROM ncnt GROUP BY 1, 2),
ngrid AS (SELECT ed.series, months.m, UNNEST(range(0, len(e) - 1)) AS bin, len(e) AS ne
          FROM ed CROSS JOIN months WHERE len(e) >= 2),
nj AS (SELECT g.series, g.m, g.ne, COALESCE(c.c, 0) AS c, COALESCE(t.tot, 0) AS tot,
              COALESCE(bc.c, 0) AS bc, COALESCE(bt.tot, 0) AS btot
       FROM ngrid g LEFT JOIN ncnt c ON c.series = g.series AND c.m = g.m AND c.bin = g.bin
       LEFT JOIN ntot t ON t.series = g.series AND t.m = g.m
       LEFT JOIN ncnt bc ON bc.series = g.series AND bc.bin = g.bin AND bc.m = (SELECT bm FROM b)
       LEFT JOIN ntot bt ON bt.series = g.series AND bt.m = (SELECT bm FROM b)),
npsi AS (SELECT series, m, SUM((a - e) * LN(a / e)) AS psi, MAX(tot > 0 AND btot > 0) AS ok FROM (
         SELECT *, (c + 1e-5) / (tot + 1e-5 * ne) AS a, (bc + 1e-5) / (btot + 1e-5 * ne) AS e FROM nj)
       GROUP BY 1, 2),
nout AS (SELECT s.series, months.m, CASE WHEN p.ok THEN p.psi ELSE 0.0 END AS psi
         FROM (SELECT DISTINCT series FROM num) s CROSS JOIN months
         LEFT JOIN npsi p ON p.series = s.series AND p.m = months.m),
cnn AS (SELECT series, m, value, COUNT(*) AS c FROM cat WHERE value IS NOT NULL GROUP BY 1, 2, 3),
csh AS (SELECT series, m, value, CAST(c AS DOUBLE) / SUM(c) OVER (PARTITION BY series, m) AS share FROM cnn),
cbase AS (SELECT series, value, share AS bshare FROM csh WHERE m = (SELECT bm FROM b)),
cgrid AS (SELECT cbase.*, months.m FROM cbase CROSS JOIN months),
cj AS (SELECT COALESCE(g.series, s.series) AS series, COALESCE(g.m, s.m) AS m,
              COALESCE(s.share, 0.0) + 1e-5 AS a, COALESCE(g.bshare, 0.0) + 1e-5 AS e
       FROM cgrid g FULL OUTER JOIN csh s ON g.series = s.series AND g.m = s.m AND g.value = s.value),
cpsi AS (SELECT series, m, SUM((a - e) * LN(a / e)) AS psi FROM cj GROUP BY 1, 2),
cout AS (SELECT s.series, months.m, COALESCE(p.psi, 0.0) AS psi
         FROM (SELECT DISTINCT series FROM cat) s CROSS JOIN months
         LEFT JOIN cpsi p ON p.series = s.series AND p.m = months.m),
allpsi AS (SELECT * FROM nout UNION ALL SELECT * FROM cout),
wide AS (SELECT m AS as_of_date,
  MAX(CASE WHEN series = 'pd_12m' THEN psi END) AS pd_score,
  MAX(CASE WHEN series = 'sector' THEN psi END) AS sector_mix,
  MAX(CASE WHEN series = 'grade' THEN psi END) AS grade_mix,
  MAX(CASE WHEN series = 'ead' THEN psi END) AS ead,
  MAX(CASE WHEN series = 'lgd' THEN psi END) AS lgd FROM allpsi GROUP BY m)"""]

_W = ["pd_score", "sector_mix", "grade_mix", "ead", "lgd"]


@query("psi_monthly", S.with_(*_PSI_BASE) + "SELECT as_of_date, "
       + ", ".join(f"{R(c)} AS {c}" for c in _W) + " FROM wide")
def q_psi_monthly(spark, sf):
    """PSI of every month against the earliest month: pd, ead, lgd, sector, grade."""
    return D.psi_monthly(materialize(A.backtest_cohorts(spark, sf)))


@query("psi_numeric", S.with_(*_PSI_BASE) + f"SELECT series, m AS as_of_month, {R('psi')} AS psi FROM nout")
def q_psi_numeric(spark, sf):
    d = A.backtest_cohorts(spark, sf).withColumn("as_of_month", F.last_day("as_of_date"))
    return D.psi_numeric_flagged(D.flagged(d, "as_of_month", _NUM), 10).withColumnRenamed("_m", "as_of_month")


@query("psi_categorical", S.with_(*_PSI_BASE) + f"SELECT series, m AS as_of_month, {R('psi')} AS psi FROM cout")
def q_psi_categorical(spark, sf):
    d = A.backtest_cohorts(spark, sf).withColumn("as_of_month", F.last_day("as_of_date"))
    return D.psi_categorical_flagged(D.flagged(d, "as_of_month", _CAT, "string")).withColumnRenamed("_m", "as_of_month")


@query("join_psi_category", S.with_(*_PSI_BASE) + f"""SELECT series, m AS as_of_month,
  CAST(COUNT(*) AS BIGINT) AS n_categories FROM cj GROUP BY 1, 2""")
def q_join_psi_category(spark, sf):
    """Size of the union of baseline and current categories per (series, month), which PSI sums over."""
    d = A.backtest_cohorts(spark, sf).withColumn("as_of_month", F.last_day("as_of_date"))
    return D.category_union(D.flagged(d, "as_of_month", _CAT, "string")).withColumnRenamed("_m", "as_of_month")


@query("psi_summary", S.with_(*_PSI_BASE) + f"""SELECT series, {R('MAX(psi)')} AS max_psi, {R('AVG(psi)')} AS mean_psi,
  CASE WHEN MAX(psi) < 0.10 THEN 'Stable' WHEN MAX(psi) < 0.25 THEN 'Moderate' ELSE 'Significant' END AS status
FROM (SELECT as_of_date, 'pd_score' AS series, pd_score AS psi FROM wide UNION ALL
      SELECT as_of_date, 'sector_mix', sector_mix FROM wide UNION ALL SELECT as_of_date, 'grade_mix', grade_mix FROM wide
      UNION ALL SELECT as_of_date, 'ead', ead FROM wide UNION ALL SELECT as_of_date, 'lgd', lgd FROM wide)
GROUP BY series""")
def q_psi_summary(spark, sf):
    return D.psi_summary(D.psi_monthly(A.backtest_cohorts(spark, sf)))


# ---------------------------------------------------------------------------
# monitoring: features of the train split (baseline) vs the test split (current)
# ---------------------------------------------------------------------------
def split_features(spark, sf):
    f = materialize(CF.build_features(spark, sf), "features")  # read for the hash ranges and the rows
    return materialize(split_stratified(f, "event_h12m", P.TEST_SIZE, P.SEED, drop_null_labels=False))


def base_cur(spark, sf):
    s = split_features(spark, sf)
    return s.filter(~F.col("is_test")), s.filter(F.col("is_test"))


SPLIT_CTES = (*CF.FEATURE_CTES, f"""sp AS (
  SELECT z.*, ROW_NUMBER() OVER (PARTITION BY COALESCE(CAST(event_h12m AS BIGINT), -1)
           ORDER BY ((customer_id % 4294967296) * 1103515245 + {P.SEED * 40503}) % 4294967296, customer_id) AS rk,
         COUNT(*) OVER (PARTITION BY COALESCE(CAST(event_h12m AS BIGINT), -1)) AS n_s FROM zz z),
spl AS (SELECT * EXCLUDE (rk, n_s), rk <= ROUND(n_s * {P.TEST_SIZE}) AS is_test FROM sp),
fbase AS (SELECT * FROM spl WHERE NOT is_test),
fcur AS (SELECT * FROM spl WHERE is_test)""")

_FL = " UNION ALL ".join(
    f"SELECT {side} AS side, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {src}"
    for side, src in ((0, "fbase"), (1, "fcur")) for c in _FEATS)
_NMIN = max(50, 5 * P.PSI_BINS)
PSI_FEAT_CTES = (*SPLIT_CTES, f"fl AS ({_FL}), flb AS (SELECT * FROM fl WHERE side = 0)",
                 S.np_edges_sql("fe0", "flb", "feature", "value", percent_probs(P.PSI_BINS)), f"""
fe AS (SELECT feature, list_sort(list_distinct(e)) AS e FROM fe0),
fst AS (SELECT feature, COUNT(CASE WHEN side = 0 THEN value END) AS n_b, COUNT(CASE WHEN side = 1 THEN value END) AS n_c,
          AVG(CASE WHEN side = 0 THEN CAST(value IS NULL AS DOUBLE) END) AS miss_b,
          AVG(CASE WHEN side = 1 THEN CAST(value IS NULL AS DOUBLE) END) AS miss_c FROM fl GROUP BY 1),
fin_b AS (SELECT l.feature, l.side, len(list_filter(e[2:len(e) - 1], lambda x: x < l.value)) AS bin
          FROM fl l JOIN fe USING (feature)
          WHERE l.value IS NOT NULL AND l.value >= e[1] AND l.value <= e[len(e)]),
fcnt AS (SELECT feature, side, bin, COUNT(*) AS c FROM fin_b GROUP BY 1, 2, 3),
ftot AS (SELECT feature, side, SUM(c) AS tot FROM fcnt GROUP BY 1, 2),
fgrid AS (SELECT feature, UNNEST(range(0, len(e) - 1)) AS bin FROM fe),
fsh AS (SELECT g.feature, g.bin, s.side,
          CASE WHEN COALESCE(c.c, 0) = 0 THEN 1e-12 ELSE CAST(c.c AS DOUBLE) / t.tot END AS sh
        FROM fgrid g CROSS JOIN (VALUES (0), (1)) AS s(side)
        LEFT JOIN fcnt c ON c.feature = g.feature AND c.bin = g.bin AND c.side = s.side
        LEFT JOIN ftot t ON t.feature = g.feature AND t.side = s.side),
fpv AS (SELECT feature, bin, MAX(CASE WHEN side = 0 THEN sh END) AS e, MAX(CASE WHEN side = 1 THEN sh END) AS a
        FROM fsh GROUP BY 1, 2),
fpsi AS (SELECT feature, SUM((a - e) * LN(a / e)) AS psi FROM fpv GROUP BY 1),
ftab AS (SELECT st.feature,
          CASE WHEN st.n_b >= {_NMIN} AND st.n_c >= {_NMIN} AND len(fe.e) >= 3 THEN round_even(p.psi, 4) END AS psi,
          round_even(st.miss_c, 4) AS missing_rate, round_even(st.miss_c - st.miss_b, 4) AS missing_delta
        FROM fst st LEFT JOIN fe ON fe.feature = st.feature LEFT JOIN fpsi p ON p.feature = st.feature),
ftab2 AS (SELECT feature, psi,
  CASE WHEN psi IS NULL THEN 'insufficient' WHEN psi < 0.10 THEN 'stable' WHEN psi < 0.25 THEN 'moderate' ELSE 'severe' END AS status,
  CASE WHEN psi IS NULL THEN 'unknown' WHEN psi < 0.10 THEN 'ok' WHEN psi < 0.25 THEN 'warn' ELSE 'severe' END AS severity,
  CAST(CASE WHEN psi IS NULL THEN 3 WHEN psi < 0.10 THEN 2 WHEN psi < 0.25 THEN 1 ELSE 0 END AS INTEGER) AS severity_rank,
  missing_rate, missing_delta FROM ftab)""")
_PSI_TAB_SEL = (f"SELECT feature, {R('psi')} AS psi, status, severity, severity_rank, "
                f"{R('missing_rate')} AS missing_rate, {R('missing_delta')} AS missing_delta FROM ftab2")


@query("psi_feature_table", S.with_(*PSI_FEAT_CTES) + _PSI_TAB_SEL)
def q_psi_feature_table(spark, sf):
    b, c = base_cur(spark, sf)
    return D.psi_feature_table(b, c, _FEATS, P.PSI_BINS)


@query("sort_psi", S.with_(*PSI_FEAT_CTES) + _PSI_TAB_SEL)
def q_sort_psi(spark, sf):
    b, c = base_cur(spark, sf)
    return D.sort_psi(D.psi_feature_table(b, c, _FEATS, P.PSI_BINS))


@query("topk_psi", S.with_(*PSI_FEAT_CTES) + _PSI_TAB_SEL
       + " ORDER BY severity DESC, psi DESC NULLS LAST, feature LIMIT 20")
def q_topk_psi(spark, sf):
    b, c = base_cur(spark, sf)
    return D.topk_psi(D.psi_feature_table(b, c, _FEATS, P.PSI_BINS), 20)


@query("psi_overall", S.with_(*PSI_FEAT_CTES) + f"""SELECT
  {R('COALESCE(round_even(QUANTILE_CONT(psi, 0.5), 4), 0.0)')} AS psi_overall,
  CAST(COUNT_IF(severity = 'severe') AS BIGINT) AS psi_severe_count,
  CAST(COUNT_IF(severity = 'warn') AS BIGINT) AS psi_warn_count,
  COALESCE(round_even(QUANTILE_CONT(psi, 0.5), 4), 0.0) >= 0.10 AS psi_alert FROM ftab2""")
def q_psi_overall(spark, sf):
    b, c = base_cur(spark, sf)
    return D.psi_overall(D.psi_feature_table(b, c, _FEATS, P.PSI_BINS))


_MR = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, (SELECT AVG(CAST({c} IS NULL AS DOUBLE)) FROM fbase) AS base_missing, "
    f"(SELECT AVG(CAST({c} IS NULL AS DOUBLE)) FROM fcur) AS cur_missing" for c in _FEATS)
MR_CTES = (*SPLIT_CTES, f"mr AS (SELECT *, cur_missing - base_missing AS delta FROM ({_MR}))")


@query("data_quality", S.with_(*MR_CTES) + f"""SELECT
  {R('round_even(AVG(cur_missing), 4)')} AS missing_rate_overall,
  CAST(COUNT_IF(delta > 0.01) AS BIGINT) AS n_missing_increases FROM mr""")
def q_data_quality(spark, sf):
    b, c = base_cur(spark, sf)
    return D.data_quality(b, c, _FEATS)


@query("topk_missing", S.with_(*MR_CTES) + f"""SELECT feature, {R('round_even(delta, 4)')} AS delta FROM mr
WHERE delta > 0.01 ORDER BY delta DESC, feature LIMIT 10""")
def q_topk_missing(spark, sf):
    b, c = base_cur(spark, sf)
    return D.topk_missing(b, c, _FEATS, 10)
