"""Import every query module so that the registry is complete."""

from tickweave.plans import catalog, catalog_clean, catalog_eval, catalog_indicators, catalog_ml, catalog_sources, catalog_stream  # noqa: F401
from tickweave.plans.catalog import ORACLE, QUERIES, flagship  # noqa: F401
