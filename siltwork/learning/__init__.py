"""Regression models on Spark ML: features, fitting, scores."""
