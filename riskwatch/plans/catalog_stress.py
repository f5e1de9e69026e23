"""Registered portfolio / stress queries and SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expr import MONITOR_GRADE_BOUNDS, PORTFOLIO_GRADE_BOUNDS, grade_band, inv_logit, logit, lookup
from ..functions.expr import stable_double_sql as R
from ..operators import portfolio as PF
from ..operators import stress as ST
from ..session import materialize
from ..sources import adapters as A
from . import sql_adapters as S
from .registry import query


def _d(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def _case(col: str, mapping: dict, default=None, as_double=True) -> str:
    parts = " ".join(f"WHEN {col} = '{k}' THEN {_d(v) if as_double else repr(v)}" for k, v in mapping.items())
    dflt = "NULL" if default is None else (_d(default) if as_double else repr(default))
    return f"(CASE {parts} ELSE {dflt} END)"


def _grade_sql(p: str, bounds, open_top=True) -> str:
    labels = "ABCDEFG"
    parts = " ".join(f"WHEN {p} < {_d(b)} THEN '{labels[i]}'" for i, b in enumerate(bounds))
    neg = "" if open_top else f"WHEN {p} < 0 THEN NULL "
    tail = f"'{labels[len(bounds)]}'" if open_top else "NULL"
    return f"(CASE WHEN {p} IS NULL THEN NULL {neg}{parts} ELSE {tail} END)"


_SECTOR_OR_NULL = _case("sector_code", PF.SECTOR_MAPPING, as_double=False)
_SECTOR = f"COALESCE({_SECTOR_OR_NULL}, 'Services')"
PORT = [S.PORTFOLIO_BASE, f"""pf0 AS (SELECT customer_id, {_SECTOR} AS sector,
   LEAST(GREATEST(pd_baseline, {_d(1e-6)}), {_d(0.5)}) AS pd_baseline FROM pbase),
pf1 AS (SELECT *, {_grade_sql('pd_baseline', PORTFOLIO_GRADE_BOUNDS)} AS grade FROM pf0),
port AS (SELECT customer_id, sector, grade, pd_baseline,
   {_case('grade', PF.EAD_BASE, PF.DEFAULTS['ead_base'])} * {_case('sector', PF.EAD_SECTOR_MULT, PF.DEFAULTS['ead_mult'])} * {_d(1.0)} AS ead,
   LEAST(GREATEST({_case('grade', PF.LGD_BASE, PF.DEFAULTS['lgd_base'])} + {_case('sector', PF.LGD_SECTOR_ADJ, PF.DEFAULTS['lgd_adj'])}, {_d(0.25)}), {_d(0.7)}) AS lgd,
   {_case('grade', PF.APR_BY_GRADE, PF.DEFAULTS['apr'])} AS apr FROM pf1)"""]

_SCEN = ", ".join(f"('{s['name']}', {i}, {_d(ST.scenario_shift(s['shocks']))})" for i, s in enumerate(ST.SCENARIOS))
_MULT = ", ".join(f"('{s['name']}', '{k}', {_d(v)})" for s in ST.SCENARIOS
                  for k, v in (s.get("sector_multipliers") or {}).items())
_Q = f"LEAST(GREATEST(pd_baseline, {_d(1e-9)}), {_d(1 - 1e-9)})"
STRESS = [*PORT, f"""sc AS (SELECT * FROM (VALUES {_SCEN}) AS t(scenario, ord, shift)),
sm AS (SELECT * FROM (VALUES {_MULT}) AS t(scenario, sector, mult)),
sx AS (SELECT p.*, sc.scenario, sc.shift,
   LN({_Q} / ({_d(1.0)} - {_Q})) + sc.shift + {_case('p.sector', ST.SECTOR_BETA, 0.0)} + {_case('p.grade', ST.GRADE_BETA, 0.0)} AS z,
   COALESCE(sm.mult, {_d(1.0)}) AS mult
   FROM port p CROSS JOIN sc LEFT JOIN sm ON sm.scenario = sc.scenario AND sm.sector = p.sector),
sp AS (SELECT *, LEAST(GREATEST(({_d(1.0)} / ({_d(1.0)} + EXP(-z))) * mult, {_d(1e-6)}), {_d(0.5)}) AS pd_stress FROM sx),
si AS (SELECT *, pd_stress * ead AS npl_proxy, pd_stress * lgd * ead AS el, {_d(1.0)} * (pd_stress * lgd * ead) AS provision,
   {_d(0.08)} * ead * SQRT(LEAST(GREATEST(pd_stress * lgd, {_d(0.0)}), {_d(1.0)})) AS capital,
   apr * ead * ({_d(1.0)} - pd_stress) - pd_stress * lgd * ead AS credit_income FROM sp),
sa AS MATERIALIZED (SELECT scenario, SUM(ead) AS ead, SUM(npl_proxy) AS npl_proxy, SUM(el) AS el, SUM(provision) AS provision,
   SUM(capital) AS capital, SUM(credit_income) AS credit_income,
   CASE WHEN GROUPING(sector) = 0 THEN 'sector' WHEN GROUPING(grade) = 0 THEN 'grade' ELSE 'overall' END AS level,
   COALESCE(sector, grade, 'all') AS key
   FROM si GROUP BY GROUPING SETS ((scenario), (scenario, sector), (scenario, grade))),
sd AS (SELECT *, {', '.join(f"CASE WHEN scenario <> 'Base' THEN {m} - MAX(CASE WHEN scenario = 'Base' THEN {m} END) OVER (PARTITION BY level, key) END AS delta_{m}" for m in ST.DELTA_MEASURES)}
   FROM sa)"""]


def portfolio(spark, sf):
    return PF.portfolio_enrich(A.portfolio_base(spark, sf), pd_col="pd_baseline")


# Decimals of money columns: sums over the whole portfolio, and amounts of one customer.
SUMS = {m: 0 for m in (*ST.MEASURES, *(f"delta_{m}" for m in ST.DELTA_MEASURES), "ead_sum")}
AMOUNTS = {m: 2 for m in ST.MEASURES}


def rs(cols, doubles, of=None) -> str:
    names = [(c, c.split(".")[-1]) for c in cols]
    return ", ".join(f"{R(c, (of or {}).get(n, 6))} AS {n}" if n in doubles else c for c, n in names)


_MEAS = list(ST.MEASURES)
_DM = [f"delta_{m}" for m in ST.DELTA_MEASURES]
_RES = ["scenario"] + _MEAS + ["level", "key"] + _DM


@query("sector_map", S.with_(S.PORTFOLIO_BASE) + f"SELECT customer_id, sector_code, {_SECTOR} AS sector FROM pbase")
def q_sector_map(spark, sf):
    b = A.portfolio_base(spark, sf)
    return b.select("customer_id", "sector_code", PF.sector_map("sector_code").alias("sector"))


@query("unmapped_sectors", S.with_(S.PORTFOLIO_BASE) + f"""SELECT CAST(COUNT_IF(({_SECTOR_OR_NULL}) IS NULL) AS BIGINT) AS n_unmapped,
  CAST(COUNT(*) AS BIGINT) AS n FROM pbase""")
def q_unmapped_sectors(spark, sf):
    """Rows whose sector code has no mapping, of all rows."""
    b = materialize(A.portfolio_base(spark, sf))
    return PF.unmapped_sectors(b).crossJoin(F.broadcast(b.agg(F.count("*").alias("n"))))


@query("grade_band", S.with_(S.PORTFOLIO_BASE) + f"""SELECT customer_id, {R('pd_baseline')} AS pd_baseline,
  {_grade_sql('pd_baseline', PORTFOLIO_GRADE_BOUNDS)} AS grade_portfolio,
  {_grade_sql('pd_baseline', MONITOR_GRADE_BOUNDS, open_top=False)} AS grade_monitoring FROM pbase""")
def q_grade_band(spark, sf):
    b = A.portfolio_base(spark, sf)
    return b.select("customer_id", "pd_baseline",
                    grade_band("pd_baseline", PORTFOLIO_GRADE_BOUNDS).alias("grade_portfolio"),
                    grade_band("pd_baseline", MONITOR_GRADE_BOUNDS, open_top=False).alias("grade_monitoring"))


_PORT_COLS = ["customer_id", "sector", "grade", "pd_baseline", "ead", "lgd", "apr"]


@query("portfolio_enrich", S.with_(*PORT) + f"SELECT {rs(_PORT_COLS, {'pd_baseline', 'ead', 'lgd', 'apr'})} FROM port")
def q_portfolio_enrich(spark, sf):
    return portfolio(spark, sf)


@query("join_lookup", S.with_(*PORT) + f"""SELECT customer_id, sector, grade,
  {R(_case('sector', ST.SECTOR_BETA, 0.0))} AS sector_beta, {R(_case('grade', ST.GRADE_BETA, 0.0))} AS grade_beta FROM port""")
def q_join_lookup(spark, sf):
    """Dictionary lookups with a default (sector / grade betas)."""
    p = portfolio(spark, sf)
    return p.select("customer_id", "sector", "grade", lookup("sector", ST.SECTOR_BETA, 0.0).alias("sector_beta"),
                    lookup("grade", ST.GRADE_BETA, 0.0).alias("grade_beta"))


_SUMQ = f"""SELECT level, key, CAST(COUNT(*) AS BIGINT) AS count, COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY level) AS share,
  AVG(pd_baseline) AS pd_mean, SUM(ead) AS ead_sum, SUM(ead) / 1e6 AS ead_m, AVG(lgd) AS lgd_mean, AVG(apr) AS apr_mean,
  SUM(pd_baseline * lgd * ead) AS el FROM (
  SELECT *, 'grade' AS level, grade AS key FROM port UNION ALL SELECT *, 'sector', sector FROM port
  UNION ALL SELECT *, 'overall', 'all' FROM port) GROUP BY level, key"""
_SUM_COLS = ["level", "key", "count", "share", "pd_mean", "ead_sum", "ead_m", "lgd_mean", "apr_mean", "el"]


@query("portfolio_summary", S.with_(*PORT) + f", ps AS ({_SUMQ}) SELECT {rs(_SUM_COLS, set(_SUM_COLS) - {'level', 'key', 'count'}, SUMS)} FROM ps", of=SUMS)
def q_portfolio_summary(spark, sf):
    return PF.portfolio_summary(portfolio(spark, sf))


@query("logit", S.with_(S.PORTFOLIO_BASE) + f"""SELECT customer_id,
  {R(f'LN({_Q} / ({_d(1.0)} - {_Q}))')} AS z,
  {R(f'{_d(1.0)} / ({_d(1.0)} + EXP(-LN({_Q} / ({_d(1.0)} - {_Q}))))')} AS p_back FROM pbase""")
def q_logit(spark, sf):
    b = A.portfolio_base(spark, sf)
    return b.select("customer_id", logit("pd_baseline").alias("z"), inv_logit(logit("pd_baseline")).alias("p_back"))


@query("join_scenario_cross", S.with_(*STRESS) + f"SELECT customer_id, scenario, {R('shift')} AS shift FROM sx")
def q_join_scenario_cross(spark, sf):
    """Every customer against every scenario (broadcast literal-size scenario table)."""
    sc = ST.scenarios_frame(spark)
    return portfolio(spark, sf).crossJoin(F.broadcast(sc)).select("customer_id", "scenario", "shift")


@query("stress_pd", S.with_(*STRESS) + f"SELECT customer_id, scenario, {R('pd_stress')} AS pd_stress FROM sp")
def q_stress_pd(spark, sf):
    return ST.stress_pd(portfolio(spark, sf), ST.scenarios_frame(spark)).select("customer_id", "scenario", "pd_stress")


_IMP = ["npl_proxy", "el", "provision", "capital", "credit_income"]


@query("stress_impacts", S.with_(*STRESS) + f"SELECT customer_id, scenario, {rs(_IMP, set(_IMP), AMOUNTS)} FROM si", of=AMOUNTS)
def q_stress_impacts(spark, sf):
    d = ST.stress_impacts(ST.stress_pd(portfolio(spark, sf), ST.scenarios_frame(spark)))
    return d.select("customer_id", "scenario", *_IMP)


_AGG = ["scenario"] + _MEAS + ["level", "key"]
AGG_SQL = S.with_(*STRESS) + f"SELECT {rs(_AGG, set(_MEAS), SUMS)} FROM sa"


def _agg(spark, sf):
    return ST.stress_aggregate(ST.stress_impacts(ST.stress_pd(portfolio(spark, sf), ST.scenarios_frame(spark))))


@query("stress_aggregate", AGG_SQL, of=SUMS)
def q_stress_aggregate(spark, sf):
    return _agg(spark, sf)


@query("union_levels", AGG_SQL, of=SUMS)
def q_union_levels(spark, sf):
    """Overall + sector + grade levels of every scenario as one grouping-sets result."""
    return _agg(spark, sf)


# the same rows by three ways: Base as a maximum, as the first row of its group, and as a group of its own
RES_SQL = S.with_(*STRESS) + f"SELECT {rs(_RES, set(_MEAS) | set(_DM), SUMS)} FROM sd"
_FIRST = ", ".join(f"CASE WHEN scenario <> 'Base' THEN {m} - FIRST_VALUE({m}) OVER w END AS delta_{m}" for m in ST.DELTA_MEASURES)
FIRST_SQL = S.with_(*STRESS, f"""fd AS (SELECT *, {_FIRST} FROM sa
   WINDOW w AS (PARTITION BY level, key ORDER BY CASE WHEN scenario = 'Base' THEN 0 ELSE 1 END, scenario))""") \
    + f"SELECT {rs(_RES, set(_MEAS) | set(_DM), SUMS)} FROM fd"
_BASE = ", ".join(f"SUM({m}) AS base_{m}" for m in ST.DELTA_MEASURES)
_LESS = ", ".join(f"CASE WHEN a.scenario <> 'Base' THEN a.{m} - b.base_{m} END AS delta_{m}" for m in ST.DELTA_MEASURES)
JOIN_SQL = S.with_(*STRESS, f"""bs AS MATERIALIZED (SELECT level, key, {_BASE} FROM sa WHERE scenario = 'Base' GROUP BY level, key),
jd AS (SELECT a.*, {_LESS} FROM sa a LEFT JOIN bs b USING (level, key))""") \
    + f"SELECT {rs(_RES, set(_MEAS) | set(_DM), SUMS)} FROM jd"


@query("stress_delta", RES_SQL, of=SUMS)
def q_stress_delta(spark, sf):
    return ST.stress_delta(_agg(spark, sf))


@query("join_scenario_delta", JOIN_SQL, of=SUMS)
def q_join_scenario_delta(spark, sf):
    return ST.stress_delta(_agg(spark, sf))


@query("stress_test", FIRST_SQL, of=SUMS)
def q_stress_test(spark, sf):
    """All seven scenarios end to end."""
    return ST.stress_test(portfolio(spark, sf))


@query("stress_summary", S.with_(*STRESS) + f"""SELECT scenario, {R('npl_proxy / 1e6')} AS npl_m,
  {R('COALESCE(delta_npl_proxy, 0.0) / 1e6')} AS delta_npl_m, {R('provision / 1e6')} AS provision_m
FROM sd WHERE level = 'overall' AND key = 'all'""")
def q_stress_summary(spark, sf):
    return ST.stress_summary(ST.stress_test(portfolio(spark, sf)))
