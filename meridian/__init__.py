"""Continuous evaluation of dataset collections on Spark.

``sources`` read catalogues and results, ``operators`` transform them,
``functions`` are column expressions, ``plans`` put operators together into
solving, ledger and reading, and ``streaming`` ingests incrementally.
"""
