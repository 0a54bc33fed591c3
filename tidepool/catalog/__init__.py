"""All registered queries. Importing this package fills the registry."""

from tidepool.catalog import chains, columns, models, reports, sources, statistics, windows
from tidepool.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "chains", "columns", "models", "reports", "sources", "statistics", "windows"]
