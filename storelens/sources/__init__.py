"""Sources: CSV files, driver-table projections, catalog tables."""

from storelens.sources.catalog import list_tables, missing_tables, read_model, require_tables
from storelens.sources.csv import (
    normalize_header,
    read_apps_csv,
    read_reviews_csv,
    read_seed_csv,
)
from storelens.sources.testdata import (
    raw_apps,
    raw_apps_from_part,
    raw_reviews,
    raw_reviews_from_lineitem,
    read_table,
)

__all__ = [
    "list_tables", "missing_tables", "normalize_header", "raw_apps",
    "raw_apps_from_part", "raw_reviews", "raw_reviews_from_lineitem",
    "read_apps_csv", "read_model", "read_reviews_csv", "read_seed_csv",
    "read_table", "require_tables",
]
