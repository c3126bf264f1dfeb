"""Record ingestion and analytics on Spark DataFrames."""
