"""Object-stream analytics on Spark: DataFrame-first operators over imaged objects and their metadata."""

__version__ = "0.1.0"
