"""Internal consistency with published result tables (values embedded as data)."""
import pytest

from riskwatch.operators.backtest import metrics_roll12

# Published monthly AUC (18 months) and its 12-row rolling mean (min 3 values).
AUC = [0.8325156143389493, 0.8438105467627635, 0.8270392460192254, 0.8518589396419484,
       0.7922085158547145, 0.8415491731665317, 0.8009762949488283, 0.8589604462474645,
       0.8276060012509464, 0.803000506842372, 0.8425268628112462, 0.801106066242785,
       0.8005352055526505, 0.8176018999052446, 0.8307688562298613, 0.8192142355510199,
       0.807495169600687, 0.8167131186099128]
ROLL = [None, None, 0.8344551357069795, 0.8388060866907217, 0.8294865725235201, 0.8314970059640222,
        0.8271369043904231, 0.8311148471225531, 0.8307249753590413, 0.8279525285073743,
        0.8292774679895445, 0.8269298511773147, 0.8242648171117898, 0.8220807632069964,
        0.8223915640578827, 0.8196711720503055, 0.8209450598624698, 0.8188753886494182]


def test_roll12_reproduces_published_column(spark):
    rows = [(f"m{i:02d}", "pd_12m", "y_event_12m", a) for i, a in enumerate(AUC)]
    m = spark.createDataFrame(rows, "as_of_month string, pd_col string, y_col string, auc double")
    got = [r.auc_roll12 for r in metrics_roll12(m, cols=("auc",)).orderBy("as_of_month").collect()]
    for g, e in zip(got, ROLL):
        assert (g is None and e is None) or g == pytest.approx(e, abs=1e-12)
