"""thermograph: analytics over hierarchical environmental sensor readings,
built on Spark DataFrames."""

__version__ = "0.1.0"
