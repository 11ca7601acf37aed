"""Weekly usage billing of workforce activity, as Spark DataFrame functions.

``functions``  text, date and number cleaning on columns
``sources``    CSV extracts in, Parquet tables out (with row counts)
``operators``  one function per table or check, DataFrames in and a DataFrame out
``plans``      the tables composed into one lazy plan, or written one after the other
"""
