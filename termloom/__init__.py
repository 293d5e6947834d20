"""termloom: counting, matching and cleaning of skill terms in text records, on Spark DataFrames."""

__version__ = "0.1.0"
