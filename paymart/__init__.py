"""paymart: a daily payment-transactions load written as Spark DataFrame
and Structured Streaming jobs (landing -> staging -> per-currency mart)."""

__version__ = "0.1.0"
