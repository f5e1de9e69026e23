"""Parameters of the registered queries over the driver tables.

The driver's panels are short (30 days of events in January 2024; orders
1995-2001), so the reference's 180-day / 60-row windows are scaled down here;
every window length remains an operator parameter. Dates used inside the SQL
oracles are derived from the same values.
"""

from __future__ import annotations

import datetime as dt

PANEL_ASOF = "2024-01-20"      # as-of date of the daily panels (events)
OBS_DAYS = 20                  # observation window (reference: 180)
RECENT_DAYS = 7
UTIL_ROWS = 10                 # "last 60 rows" (reference: 60)
BREACH_ROWS = 15               # "last 90 rows" (reference: 90)
CASHFLOW_ROWS = 10             # (reference: 60)
NPE_DPD = 90
COVENANT_ASOF = "2001-06-30"   # covenant history comes from the quarterly financials
COVENANT_DAYS = 180
LABEL_HORIZON = 365
LABEL_DPD = 30                 # dpd threshold of the default streak (reference: 90)
LABEL_STREAK = 2               # minimum streak rows (reference: 30)
MIN_GROUP = 10
WINSOR = (0.01, 0.99)

# backtest
MONTH_START = "1995-01"
MONTH_END = "2001-08"
MIN_RECORDS = 100
AMBER = 0.02
RED = 0.05
SWEEP = (0.005, 0.10, 0.005)
N_BINS = 10

# monitoring (cohort-based): baseline month vs current month
MONITOR_BASE_MONTH = "1995-01-31"
MONITOR_CUR_MONTH = "2001-07-31"
BASELINE_METRICS = {"auc": 0.9309, "pr_auc": 0.1782, "ks": 0.7927, "brier": 0.0194}
PSI_BINS = 10

# model
SEED = 42
TEST_SIZE = 0.2
CALIBRATED_RED, CALIBRATED_AMBER = 0.20, 0.05   # absolute cutoffs of calibrated probabilities


def days_before(d: str, n: int) -> str:
    return (dt.date.fromisoformat(d) - dt.timedelta(days=n)).isoformat()


def days_after(d: str, n: int) -> str:
    return (dt.date.fromisoformat(d) + dt.timedelta(days=n)).isoformat()


def sweep_cuts(lo: float = SWEEP[0], hi: float = SWEEP[1], step: float = SWEEP[2]) -> list[float]:
    """Cuts lo, lo+step, ... <= hi built from decimals (round to 6 places)."""
    n = int((hi - lo) / step + 1e-9)
    return [round(lo + i * step, 6) for i in range(n + 1)]
