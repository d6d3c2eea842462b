"""tidemark: point-in-time training sets, preprocessing and classifier workflows on Spark."""

__version__ = "0.1.0"
