"""Readers for the nine warehouse tables the job consumes."""

from stockout.sources.tables import TABLES, Sources, read_jdbc, read_parquet_root
from stockout.sources.testdata import from_testdata

__all__ = ["TABLES", "Sources", "read_parquet_root", "read_jdbc", "from_testdata"]
