"""All registered queries."""

from tidecast.plans import linear_queries, metric_queries, model_queries, series_queries  # noqa: F401
from tidecast.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
