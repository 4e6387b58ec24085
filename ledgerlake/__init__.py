"""Retail lake analytics on Spark."""

from .functions.columns import add_lineage_columns
from .operators.merge import merge_to_silver
from .operators.quality import validate_silver
from .sources.lake import lake_files_path

__all__ = ["add_lineage_columns", "lake_files_path", "merge_to_silver", "validate_silver"]
