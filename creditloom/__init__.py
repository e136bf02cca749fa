"""Consumer-lending features, labels, drift monitoring and model selection on Spark DataFrames."""
