"""Regression, churn, forecast and forest models on Spark ML and DataFrames."""
