"""Forecasting models on Spark ML: OLS, ridge, random forest, and their scoring."""
