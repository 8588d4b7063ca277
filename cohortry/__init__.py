"""Cohort building and group comparison on Spark.

Every public function takes DataFrames (or Columns) and returns a DataFrame (or Column); nothing is
collected except single-row or bounded summaries, which say so.
"""
