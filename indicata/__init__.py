"""indicata: economic-style time-series indicators as Spark DataFrame jobs."""

__version__ = "0.1.0"
