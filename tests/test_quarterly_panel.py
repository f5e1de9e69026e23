"""The quarterly panel: its sums, and how often its rows move."""

import datetime as dt

import __spark_entry__ as E
import pytest

from riskwatch.operators import features as FE
from riskwatch.sources import adapters as A

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def tables(spark, tmp_path):
    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    day = dt.datetime(2000, 2, 3)
    write("lineitem", [(1, 2.0, 100.0, 0.1, 0.05, "R", "O", day), (1, 1.0, 50.0, None, 0.0, None, "F", day),
                       (2, None, 10.0, 0.0, 0.1, "A", None, dt.datetime(2000, 3, 31)), (2, 1.0, None, 0.0, 0.0, "A", "O", dt.datetime(2000, 4, 1)),
                       (3, 1.0, 1.0, 0.0, 0.0, "A", "O", day), (None, 1.0, 1.0, 0.0, 0.0, "A", "O", day)],
          "l_orderkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
          "l_linestatus string, l_shipdate timestamp")
    write("orders", [(1, 7), (2, 7), (3, None), (None, 7)], "o_orderkey long, o_custkey long")
    write("customer", [(7, "BUILDING", 5000.0), (8, "BUILDING", 1.0), (None, "BUILDING", 1.0)],
          "c_custkey long, c_mktsegment string, c_acctbal double")
    return str(tmp_path)


def test_sums_of_a_customers_lines(spark, tables):
    first, second = (r.asDict() for r in A.fin_quarterly(spark, tables).orderBy("fq_date").collect())
    assert first == {
        "customer_id": 7, "fq_date": dt.date(2000, 1, 1), "sector_code": "BUILDING", "size_bucket": "Corp",
        "revenue": pytest.approx(90 + 10), "cogs": pytest.approx(0.6 * 160), "ebitda": pytest.approx(30 + 4),
        "ebit": pytest.approx(25 + 3.5), "interest_expense": pytest.approx(5 + 0 + 1), "total_debt": pytest.approx(200),
        "current_assets": pytest.approx(300 + 100), "current_liab": pytest.approx(10), "inventory": pytest.approx(300),
        "ar": pytest.approx(100), "ap": pytest.approx(5)}
    assert second["fq_date"] == dt.date(2000, 4, 1) and second["inventory"] == 100
    assert second["revenue"] is None and second["current_liab"] is None and second["total_debt"] == 0


def test_lines_move_by_customer_once(spark):
    """Sums an order are wider than its lines: the panel moves lines, and the window over its quarters moves nothing."""
    plan = E.queries()["fin_ratios"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2  # broadcast joins of small tables leave one


def test_ratios_and_covenants_are_one_pass(spark):
    """The assembly makes the panel's sums once: the lines of a customer are read and added up for both."""
    plan = E.queries()["join_feature_assembly"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_orderkey") == 1


def test_covenants_beside_quarters_are_those_joined(spark):
    """Null keys, dates and sums, equal dates, and customers without a test in the window."""
    schema = "customer_id long, fq_date date, sector_code string, size_bucket string, " + ", ".join(f"{c} double" for c in FE.FIN_MEASURES)
    rows = []
    for customer in (1, 2, 3, 4, None):
        for k, month in enumerate((1, 4, 7, 10)):
            x = [float((customer or 5) * (k + 1) * (i + 1) % 7) for i in range(len(FE.FIN_MEASURES))]
            x = [None if (i + k + (customer or 0)) % 5 == 0 else v for i, v in enumerate(x)]
            rows.append((customer, dt.date(1990 if customer == 3 else 2000, month, 1), "A", None, *x))
    rows += [(4, None, "A", None, *[1.0] * len(FE.FIN_MEASURES)), (6, dt.date(2000, 7, 1), None, "B", *[None] * len(FE.FIN_MEASURES))]
    fin = spark.createDataFrame(rows, schema)
    p = FE.FeatureParams(asof="2000-08-01", obs_days=180)
    ratios, tests = FE.ratios_and_covenants(fin, FE.covenant_test(fin), p)
    joined = ratios.join(tests, "customer_id", "left")
    beside, none = FE.ratios_and_covenants(fin, None, p)
    assert none is None and beside.columns == joined.columns and beside.dtypes == joined.dtypes
    found = sorted(map(str, beside.collect()))
    assert found == sorted(map(str, joined.collect()))
    assert len({r.covenant_breach_cnt_180d for r in beside.collect()}) > 2
