"""Price analytics for commodity time series, expressed as Spark DataFrame jobs."""

__version__ = "0.1.0"
