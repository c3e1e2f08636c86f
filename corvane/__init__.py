"""Table-to-table analytics jobs on PySpark.

Every job takes DataFrames with explicit key columns and returns a DataFrame.
"""
