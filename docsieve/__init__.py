"""docsieve: search, ranking and table maintenance over large document tables, on Spark.

Every operator is a function from DataFrames (or Columns) to DataFrames, so the whole
request ends up in one Catalyst plan and runs on the executors.
"""
