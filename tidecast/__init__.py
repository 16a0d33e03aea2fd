"""tidecast: daily booking metrics and their forecasts as Spark jobs."""

__version__ = "0.1.0"
