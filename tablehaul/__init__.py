"""Loading and refreshing reporting tables on Spark."""

from tablehaul.errors import LoadError
from tablehaul.operators.consolidate import consolidate, consolidate_partitions, fan_out, load_tables
from tablehaul.operators.schema import create_like, ensure_table, schema_diff
from tablehaul.operators.sinks import (append_by_name, append_by_position, replace_partition, replace_partitions,
                                       replace_table, write_jdbc)
from tablehaul.operators.validate import validate_extract
from tablehaul.plans.jobs import DryRun, bulk_import, load_blob_listing, run_sql_steps, transfer
from tablehaul.sources import (Ranges, conform, extract, gate, jdbc_options, listing_faults, missing_pages, parse_listing, read_jdbc,
                               read_table, scalar, staged_extract)
from tablehaul.streaming.incremental import incremental_load, incremental_load_partitions

__all__ = ["DryRun", "LoadError", "Ranges", "append_by_name", "append_by_position", "bulk_import", "conform",
           "consolidate", "consolidate_partitions", "create_like", "ensure_table", "extract", "fan_out", "gate",
           "incremental_load", "incremental_load_partitions", "jdbc_options", "listing_faults", "load_blob_listing", "load_tables", "missing_pages", "parse_listing", "read_jdbc",
           "read_table", "replace_partition", "replace_partitions", "replace_table", "run_sql_steps", "scalar",
           "schema_diff", "staged_extract", "transfer", "validate_extract", "write_jdbc"]
