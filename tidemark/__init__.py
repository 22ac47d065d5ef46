"""Batch analytics on Spark DataFrames.

Every operator takes DataFrames (or column names) and returns DataFrames, so
Catalyst sees one declarative plan.  Fits return Spark ML models.  Nothing in
the package starts a session or changes its settings.
"""
