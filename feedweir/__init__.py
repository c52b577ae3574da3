"""feedweir: change feeds, incremental slices and nested records as plain Spark DataFrames."""

__version__ = "0.1.0"
