"""tastespark: rating and recommendation pipelines expressed as Spark DataFrame plans."""

__version__ = "0.1.0"
