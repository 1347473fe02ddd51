"""Spark engine that turns loosely curated tables into model-ready data and models."""
