"""holdfast: brokerage holdings, cash flow and data governance on Spark.

Every operator is a plain function from DataFrames to DataFrames.  There are no
Python UDFs: all expressions are Spark built-ins, so plans stay inside
whole-stage code generation.
"""
