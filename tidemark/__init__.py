"""Table-level curation, provenance and publishing jobs for Spark DataFrames."""

__version__ = "0.1.0"
