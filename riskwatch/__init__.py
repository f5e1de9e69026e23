"""riskwatch — Spark-native early-warning analytics for corporate credit portfolios.

Every operator is a function ``(DataFrame, params) -> DataFrame`` built from
built-in Spark SQL expressions, aggregates, windows, joins and ``pyspark.ml``.
Sub-packages:

* ``sources``   — readers, driver-table adapters, sinks (upsert, scored, report)
* ``functions`` — column expressions and reusable window / prefix-sum helpers
* ``operators`` — features, robust scaling, rank metrics, calibration, drift,
  backtest, monitoring, stress, portfolio, model, explanation, reports
* ``plans``     — registered end-to-end queries and their SQL oracles
* ``streaming`` — ``foreachBatch`` adapter for the re-runnable upsert sink
"""

__version__ = "0.1.0"
