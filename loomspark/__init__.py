"""Experience analytics on Spark: curation, views, splits, retrieval, time windows and statistics as DataFrame plans."""

__version__ = "0.1.0"
