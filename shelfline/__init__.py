"""Weekly retail stock and sales analytics on Spark."""

__version__ = "0.1.0"
