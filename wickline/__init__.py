"""Candle analytics and model evaluation as Spark DataFrame operations."""
