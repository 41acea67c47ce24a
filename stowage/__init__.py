"""Storage-catalogue analytics as Spark DataFrame operators.

Operators take DataFrames and return DataFrames.  They hold no data on the driver,
start no job unless their docstring says so, and leave the physical plan to Spark.
"""
