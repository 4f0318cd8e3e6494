"""clickloom: click-conversion and time-series feature engineering on Spark.

Every operator takes DataFrames or Columns and returns a lazy DataFrame or
Column; jobs start only when a table is written, pinned or a model is fitted.
"""
