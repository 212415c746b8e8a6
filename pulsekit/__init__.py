"""pulsekit: profiling, cleaning, features, sampling, Spark ML training and evaluation, and distribution tests for
labelled numeric tables, all as distributed Spark DataFrame jobs."""

__version__ = "0.1.0"
