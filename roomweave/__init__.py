"""roomweave: a Spark-first engine for spatial question-answering datasets and their records."""

__version__ = "0.1.0"
