"""Scans, the retail view over the given tables, stage tables and sinks."""

from basketflow.sources.retail_view import Retail, load_retail
from basketflow.sources.tables import read_table

__all__ = ["Retail", "load_retail", "read_table"]
