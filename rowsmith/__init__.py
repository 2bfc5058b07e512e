"""Operators on Spark DataFrames: from profiling and cleaning to fitted chains, searches and training text."""

__version__ = "0.1.0"
