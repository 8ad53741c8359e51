"""Agent-log curation on Spark: DataFrame operators for building training data."""

__version__ = "0.1.0"
