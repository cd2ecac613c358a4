"""Daily country metrics, data-quality checks and observability as Spark DataFrame jobs."""

__version__ = "0.1.0"
