"""shelfcast: retail time-series preparation, profiling, forecasting and monitoring on Spark."""

__version__ = "0.1.0"
