"""Event-time analytics over streams and tables of price ticks, built on Spark DataFrames.

Every transform takes and returns a DataFrame and runs unchanged on batch and Structured Streaming input.
"""

__version__ = "0.1.0"
