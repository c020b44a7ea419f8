"""ledgerlens: suspicious-payment analytics expressed as Spark DataFrames.

Sub-packages
------------
``sources``    table adapters, layered parquet storage
``functions``  column-level helpers (money, time, risk, text)
``operators``  reusable DataFrame operators (dedup, sweeps, prefix sums, joins, quality, tree attributions)
``plans``      the datasets: silver, gold, features, rules, model, KPIs and the batch runner
``streaming``  Structured Streaming twins of the batch datasets
"""
