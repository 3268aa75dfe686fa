"""Sources (Parquet scans and interaction views) and sinks (Parquet writes)."""

from encore.sources.tables import load_table, TABLES
from encore.sources.views import (
    sales_interactions, event_interactions, track_catalogue, sales_interactions_raw,
    sales_interactions_with_nulls,
)
from encore.sources.sinks import write_parquet, write_by_user, write_bucketed_by_user, bounded_export, page

__all__ = [
    "load_table", "TABLES", "sales_interactions", "event_interactions", "track_catalogue",
    "sales_interactions_raw", "sales_interactions_with_nulls", "write_parquet", "write_by_user", "write_bucketed_by_user",
    "bounded_export", "page",
]
