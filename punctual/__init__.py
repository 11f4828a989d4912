"""Operational-ML tables on Spark: labels, splits, samples, history, stores, scores and checks."""

__version__ = "0.1.0"
