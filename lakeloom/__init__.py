"""lakeloom: layered lakehouse loads and distributed data profiling on Spark DataFrames."""

__version__ = "0.1.0"
