"""docframe: document analytics on Spark DataFrames."""
