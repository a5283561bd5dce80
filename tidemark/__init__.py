"""Incremental warehouse loading, entity resolution and data-quality gating on Spark DataFrames."""

__version__ = "0.1.0"
