"""Photo-metadata trend analytics on PySpark: plain functions, DataFrames in and out."""
