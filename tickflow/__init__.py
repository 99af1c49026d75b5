"""tickflow: tick analytics, model scoring and drift monitoring on Spark DataFrames."""
