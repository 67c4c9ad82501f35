"""Writers and table maintenance."""

from reviewlake.sinks.catalog import TABLES, TableSpec, create_table, evolve_table
from reviewlake.sinks.export import export_documents
from reviewlake.sinks.full import write_full
from reviewlake.sinks.maintenance import (
    compact,
    compact_table,
    drop_partitions,
    drop_table_partitions,
    partition_location,
    retain_days,
    zorder_key,
)
from reviewlake.sinks.purge import append_manifest, list_files, loaded_files, purge_loaded
from reviewlake.sinks.partitions import (
    insert_partitions,
    new_run_id,
    own_rows,
    stamp_month,
    write_partitions,
)
from reviewlake.sinks.records import append_metrics, fold_metrics, read_metrics

__all__ = [
    "append_manifest", "append_metrics", "compact", "compact_table", "create_table", "drop_partitions",
    "drop_table_partitions", "evolve_table", "export_documents", "fold_metrics", "insert_partitions",
    "list_files", "loaded_files", "new_run_id", "own_rows", "partition_location", "purge_loaded",
    "read_metrics", "retain_days", "stamp_month", "TABLES", "TableSpec", "write_full", "write_partitions",
    "zorder_key",
]
