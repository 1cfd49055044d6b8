"""millrace: load, maintain, reshape and mask tables with Spark DataFrames."""

__version__ = "0.1.0"
