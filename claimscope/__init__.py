"""Claims-fraud analytics on PySpark: every operator maps DataFrames to DataFrames."""
