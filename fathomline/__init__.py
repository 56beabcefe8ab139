"""A Spark engine for irregular time-series of many sensors, with operators for the preparation of training text."""

__version__ = "0.1.0"
