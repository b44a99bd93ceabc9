"""Delay analytics on Spark: cleaning, features, reports, models and explanations as DataFrame operators."""
