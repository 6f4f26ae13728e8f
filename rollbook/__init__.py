"""Monthly company-register processing on Spark DataFrames."""
