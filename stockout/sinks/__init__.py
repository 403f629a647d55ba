"""Writers for the two result tables: day-partitioned, idempotent per day; or both behind one manifest."""

from stockout.sinks.store import CommitConflict, ResultStore
from stockout.sinks.tables import (ALL_DAYS, check_keys, drop_table, load_days, load_report, load_snapshot,
                                   output_root, replace_table, write_report, write_snapshot)

__all__ = ["ALL_DAYS", "CommitConflict", "ResultStore", "check_keys", "drop_table", "load_days", "load_report", "load_snapshot", "output_root",
           "replace_table", "write_report", "write_snapshot"]
