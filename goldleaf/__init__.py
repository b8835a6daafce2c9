"""goldleaf: a retail medallion pipeline (bronze -> silver -> gold -> quality)
written as plain Spark DataFrame / SQL jobs."""

__version__ = "0.1.0"
