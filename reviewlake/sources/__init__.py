"""Readers: landing files, feed pages, lake tables and the control table."""

from reviewlake.sources.control import (
    config_from_documents,
    explode_rules,
    latest_config,
    load_flow_config,
    type_config_strings,
)
from reviewlake.sources.feed import flatten_feed, read_feed_pages, unreadable_pages
from reviewlake.sources.landing import (
    app_folder,
    existing_paths,
    landing_paths,
    read_flow_source,
    read_landing,
    source_paths,
)
from reviewlake.sources.tables import (
    partition_columns,
    read_partitioned,
    scan_days_back,
    scan_month,
    select_tagged,
    table_column_types,
    table_location,
)

__all__ = [
    "app_folder", "config_from_documents", "existing_paths", "explode_rules", "flatten_feed",
    "landing_paths", "latest_config", "load_flow_config", "partition_columns", "read_feed_pages",
    "read_flow_source", "read_landing", "read_partitioned", "scan_days_back", "scan_month",
    "select_tagged", "source_paths", "table_column_types", "table_location", "type_config_strings",
    "unreadable_pages",
]
