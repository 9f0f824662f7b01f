"""postpulse: market-post analytics on Spark DataFrames."""
