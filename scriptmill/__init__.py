"""Transcript quality engine and corpus tools on Spark DataFrames."""

__version__ = "0.1.0"
