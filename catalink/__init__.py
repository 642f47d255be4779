"""catalink: cleaning, linking and comparing catalogue tables on Spark."""

__version__ = "0.1.0"
