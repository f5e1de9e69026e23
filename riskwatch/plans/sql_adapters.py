"""SQL text of the driver-table adapters and shared CTEs for the DuckDB oracles.

These are written independently of the DataFrame code in
``riskwatch.sources.adapters`` so that the oracle is a real second opinion.
"""

from __future__ import annotations

from . import params as P

FIN = """fin AS (
  SELECT o.o_custkey AS customer_id,
         CAST(date_trunc('quarter', l.l_shipdate) AS DATE) AS fq_date,
         c.c_mktsegment AS sector_code,
         CASE WHEN c.c_acctbal >= 5000 THEN 'Corp' ELSE 'SME' END AS size_bucket,
         SUM(l.l_extendedprice * (1 - l.l_discount))      AS revenue,
         SUM(l.l_extendedprice * 0.6)                     AS cogs,
         SUM(l.l_extendedprice * (0.40 - l.l_discount))   AS ebitda,
         SUM(l.l_extendedprice * (0.35 - l.l_discount))   AS ebit,
         SUM(l.l_extendedprice * l.l_tax)                 AS interest_expense,
         SUM(CASE WHEN l.l_returnflag = 'R' THEN 2 * l.l_extendedprice ELSE 0 END) AS total_debt,
         SUM(CASE WHEN l.l_linestatus = 'O' THEN l.l_extendedprice ELSE 0 END + 100 * l.l_quantity) AS current_assets,
         SUM(CASE WHEN l.l_returnflag = 'A' THEN l.l_extendedprice ELSE 0 END) AS current_liab,
         SUM(100 * l.l_quantity)                          AS inventory,
         SUM(CASE WHEN l.l_linestatus = 'O' THEN l.l_extendedprice ELSE 0 END) AS ar,
         SUM(CASE WHEN l.l_returnflag = 'A' THEN 0.5 * l.l_extendedprice ELSE 0 END) AS ap
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                  JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2, 3, 4)"""

CREDIT = """credit AS (
  SELECT user_id AS customer_id, CAST(ts AS DATE) AS date,
         CAST(100 + 5 * (user_id % 20) AS DOUBLE) AS credit_limit,
         SUM(value) AS utilized,
         CASE WHEN SUM(value) > 100 + 5 * (user_id % 20) THEN 1 ELSE 0 END AS breach_flag,
         CAST(30 * SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS dpd_days
  FROM events GROUP BY user_id, CAST(ts AS DATE))"""

CASH = """cash AS (
  SELECT user_id AS customer_id, CAST(ts AS DATE) AS date,
         SUM(CASE WHEN event_type IN ('purchase', 'signup') THEN value ELSE 0 END) AS inflow,
         SUM(CASE WHEN event_type IN ('purchase', 'signup') THEN 0 ELSE value END) AS outflow
  FROM events GROUP BY user_id, CAST(ts AS DATE))"""

COHORTS = """cohorts AS (
  SELECT o.o_orderkey AS row_id, o.o_custkey AS customer_id, CAST(o.o_orderdate AS DATE) AS as_of_date,
         c.c_mktsegment AS sector, SUBSTR(o.o_orderpriority, 1, 1) AS grade,
         CAST(ROUND(CAST(o.o_totalprice AS DECIMAL(18,2)) * CAST(0.0000004 AS DECIMAL(10,7)), 3) AS DOUBLE) AS pd_12m,
         CASE WHEN (o.o_orderkey * 7919 + o.o_custkey * 104729) % 1000 < o.o_totalprice / 500000 * 400 THEN 1 ELSE 0 END AS y_event_12m,
         o.o_totalprice AS ead, CAST(25 + c.c_nationkey % 25 AS DOUBLE) / 100 AS lgd
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""

PORTFOLIO_BASE = """pbase AS (
  SELECT c_custkey AS customer_id,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'MFG' WHEN 'BUILDING' THEN 'CON'
              WHEN 'FURNITURE' THEN 'RET' WHEN 'MACHINERY' THEN 'ENG' ELSE c_mktsegment END AS sector_code,
         LEAST(GREATEST((10000 - c_acctbal) / 50000, CAST(0.000001 AS DOUBLE)), CAST(0.5 AS DOUBLE)) AS pd_baseline
  FROM customer)"""


def fin_ttm() -> str:
    return """fin_ttm AS (
  SELECT *,
    SUM(ebit) OVER w4 AS ebit_ttm, SUM(ebitda) OVER w4 AS ebitda_ttm,
    SUM(interest_expense) OVER w4 AS interest_ttm, SUM(revenue) OVER w4 AS revenue_ttm,
    SUM(cogs) OVER w4 AS cogs_ttm,
    ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY fq_date DESC) AS rn_desc
  FROM fin
  WINDOW w4 AS (PARTITION BY customer_id ORDER BY fq_date ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)),
fin_r AS (
  SELECT customer_id, fq_date, sector_code, size_bucket, rn_desc,
    ebit_ttm / NULLIF(interest_ttm, 0) AS icr_ttm,
    (ebitda_ttm - 0.3 * ebitda_ttm) / NULLIF(interest_ttm, 0) AS dscr_ttm_proxy,
    total_debt / NULLIF(ebitda_ttm, 0) AS debt_to_ebitda,
    current_assets / NULLIF(current_liab, 0) AS current_ratio,
    365 * ar / NULLIF(revenue_ttm, 0) AS dso,
    365 * ap / NULLIF(cogs_ttm, 0) AS dpo,
    365 * inventory / NULLIF(cogs_ttm, 0) AS doh
  FROM fin_ttm),
fin_c AS (SELECT *, dso + doh - dpo AS ccc FROM fin_r),
fin_last AS (
  SELECT a.customer_id, a.sector_code, a.size_bucket, a.icr_ttm, a.dscr_ttm_proxy,
         a.debt_to_ebitda, a.current_ratio, a.dso, a.dpo, a.doh, a.ccc,
         a.dso - b.dso AS delta_dso_qoq, a.ccc - b.ccc AS delta_ccc_qoq
  FROM fin_c a LEFT JOIN fin_c b ON a.customer_id = b.customer_id AND b.rn_desc = 2
  WHERE a.rn_desc = 1)"""


def behav(asof=P.PANEL_ASOF, days=P.OBS_DAYS, recent=P.RECENT_DAYS, util_rows=P.UTIL_ROWS,
          breach_rows=P.BREACH_ROWS) -> str:
    start = P.days_before(asof, days)
    rstart = P.days_before(asof, recent)
    return f"""cw AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY date DESC) AS rn
  FROM credit WHERE date >= DATE '{start}' AND date <= DATE '{asof}'),
behav AS (
  SELECT customer_id,
    AVG(CASE WHEN rn <= {util_rows} THEN utilized END)
      / NULLIF(AVG(CASE WHEN rn <= {util_rows} THEN credit_limit END), 0) AS util_mean_60d,
    QUANTILE_CONT(CASE WHEN rn <= {util_rows} THEN utilized END, 0.95)
      / NULLIF(AVG(CASE WHEN rn <= {util_rows} THEN credit_limit END), 0) AS util_p95_60d,
    CAST(COALESCE(SUM(CASE WHEN rn <= {breach_rows} THEN breach_flag END), 0) AS BIGINT) AS limit_breach_cnt_90d,
    CAST(MAX(dpd_days) AS BIGINT) AS dpd_max_180d,
    CASE WHEN COUNT(*) >= 2
         THEN REGR_SLOPE(CAST(dpd_days AS DOUBLE), CAST(date_diff('day', DATE '{start}', date) AS DOUBLE))
         ELSE 0.0 END AS dpd_trend_180d,
    AVG(CASE WHEN date > DATE '{rstart}'
             THEN CASE WHEN dpd_days > 0 AND dpd_days < 30 THEN 1.0 ELSE 0.0 END END) AS near_due_freq_7d
  FROM cw GROUP BY customer_id)"""


def cashf(asof=P.PANEL_ASOF, days=P.OBS_DAYS, rows=P.CASHFLOW_ROWS) -> str:
    start = P.days_before(asof, days)
    return f"""cfw AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY date DESC) AS rn
  FROM cash WHERE date >= DATE '{start}' AND date <= DATE '{asof}'),
cashf AS (
  SELECT customer_id,
    AVG(CASE WHEN rn <= {rows} THEN inflow END) AS inflow_mean_60d,
    AVG(CASE WHEN rn <= {rows} THEN outflow END) AS outflow_mean_60d,
    (QUANTILE_CONT(inflow, 0.5) - AVG(CASE WHEN rn <= {rows} THEN inflow END))
      / NULLIF(QUANTILE_CONT(inflow, 0.5), 0) AS inflow_drop_60d
  FROM cfw GROUP BY customer_id)"""


def covenant() -> str:
    def one(name, thr, actual, op):
        return (f"SELECT customer_id, fq_date AS date, '{name}' AS covenant_name, "
                f"CAST({thr} AS DOUBLE) AS threshold, {actual} AS actual, "
                f"CAST(CASE WHEN {actual} {op} {thr} THEN 1 ELSE 0 END AS INTEGER) AS breach_flag FROM cov_base")
    parts = [
        one("ICR_min", "2.0", "(CASE WHEN i > 0 THEN e / (i + 1e-6) ELSE 5.0 END)", "<"),
        one("Debt_to_EBITDA_max", "4.0",
            "(CASE WHEN d > 0 THEN total_debt / (d + 1e-6) ELSE 10.0 END)", ">"),
        one("Current_Ratio_min", "1.0", "(current_assets / (current_liab + 1e-6))", "<"),
        one("DSCR_min_proxy", "1.1", "(CASE WHEN i > 0 THEN d / (i + 1e-6) ELSE 5.0 END)", "<"),
    ]
    return """cov_base AS (
  SELECT customer_id, fq_date,
    COALESCE(SUM(ebit) OVER w4, 0) AS e, COALESCE(SUM(interest_expense) OVER w4, 0) AS i,
    COALESCE(SUM(ebitda) OVER w4, 0) AS d, total_debt, current_assets, current_liab
  FROM fin WINDOW w4 AS (PARTITION BY customer_id ORDER BY fq_date ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)),
cov AS (""" + "\n  UNION ALL ".join(parts) + ")"


def covf(asof=P.COVENANT_ASOF, days=P.COVENANT_DAYS) -> str:
    start = P.days_before(asof, days)
    return f"""covf AS (
  SELECT customer_id, CAST(MAX(breach_flag) AS DOUBLE) AS covenant_breach_any_180d,
         CAST(SUM(breach_flag) AS BIGINT) AS covenant_breach_cnt_180d
  FROM cov WHERE date >= DATE '{start}' AND date <= DATE '{asof}' GROUP BY customer_id)"""


def labels(asof=P.PANEL_ASOF, horizon=P.LABEL_HORIZON, dpd=P.LABEL_DPD, streak=P.LABEL_STREAK) -> str:
    end = P.days_after(asof, horizon)
    return f"""fut AS (
  SELECT customer_id, date, COALESCE(dpd_days >= {dpd}, FALSE) AS ok FROM credit
  WHERE date > DATE '{asof}' AND date <= DATE '{end}'),
isl AS (
  SELECT customer_id, ok,
    SUM(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY customer_id ORDER BY date
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g
  FROM fut),
runs AS (SELECT customer_id, g, SUM(CASE WHEN ok THEN 1 ELSE 0 END) AS r FROM isl GROUP BY 1, 2),
streak AS (SELECT customer_id, MAX(r) AS s FROM runs GROUP BY 1),
labels AS (
  SELECT u.customer_id, DATE '{asof}' AS asof_date,
    CAST(CASE WHEN COALESCE(s.s, 0) >= {streak} THEN 1 ELSE 0 END AS INTEGER) AS event_h12m
  FROM (SELECT DISTINCT customer_id FROM credit) u LEFT JOIN streak s ON u.customer_id = s.customer_id)"""


def npe(asof=P.PANEL_ASOF, recent=P.RECENT_DAYS, dpd=P.NPE_DPD) -> str:
    rstart = P.days_before(asof, recent)
    return f"""npe AS (
  SELECT customer_id FROM credit WHERE date > DATE '{rstart}' AND date <= DATE '{asof}'
  GROUP BY customer_id HAVING MAX(dpd_days) >= {dpd})"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def rnd(expr: str, alias: str, digits: int = 6) -> str:
    return f"ROUND({expr}, {digits}) + 0.0 AS {alias}"


def np_edges_sql(name: str, src: str, keys: str, col: str, probs) -> str:
    """Linear-interpolation quantile edges per ``keys`` written out as order
    statistics (virtual index (n - 1) q, two-sided lerp); ``{name}`` has
    ``keys, e`` = list of edges in probability order (not deduplicated)."""
    qv = ", ".join(f"({i}, CAST('{q!r}' AS DOUBLE))" for i, q in enumerate(probs))
    return f"""{name}_o AS (
  SELECT {keys}, {col} AS v, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {col}) - 1 AS pos,
         COUNT(*) OVER (PARTITION BY {keys}) AS t FROM {src} WHERE {col} IS NOT NULL),
{name}_i AS (
  SELECT m.*, qq.i, (CAST(m.t AS DOUBLE) - CAST(1.0 AS DOUBLE)) * qq.q AS vi
  FROM (SELECT DISTINCT {keys}, t FROM {name}_o) m CROSS JOIN (VALUES {qv}) AS qq(i, q)),
{name}_p AS (
  SELECT *, CASE WHEN vi >= t - 1 THEN t - 1 WHEN vi < 0 THEN 0 ELSE CAST(FLOOR(vi) AS BIGINT) END AS lo,
    CASE WHEN vi >= t - 1 THEN t - 1 WHEN vi < 0 THEN 0 ELSE CAST(FLOOR(vi) AS BIGINT) + 1 END AS hi,
    CASE WHEN vi >= t - 1 OR vi < 0 THEN CAST(0.0 AS DOUBLE) ELSE vi - FLOOR(vi) END AS g
  FROM {name}_i),
{name}_v AS (
  SELECT x.*, a.v AS va, b.v AS vb FROM {name}_p x
  JOIN {name}_o a ON {' AND '.join(f'a.{k.strip()} = x.{k.strip()}' for k in keys.split(','))} AND a.pos = x.lo
  JOIN {name}_o b ON {' AND '.join(f'b.{k.strip()} = x.{k.strip()}' for k in keys.split(','))} AND b.pos = x.hi),
{name} AS (
  SELECT {keys}, list(CASE WHEN g >= 0.5 THEN vb - (vb - va) * (CAST(1.0 AS DOUBLE) - g)
                           ELSE va + (vb - va) * g END ORDER BY i) AS e
  FROM {name}_v GROUP BY {keys})"""
