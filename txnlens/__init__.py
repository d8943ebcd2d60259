"""txnlens — Spark-native analytics for label-imbalanced transaction data."""

__version__ = "0.1.0"
