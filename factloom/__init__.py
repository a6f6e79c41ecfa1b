"""Collections of published tables in, a star schema of observations out, on Spark."""

__version__ = "0.1.0"
