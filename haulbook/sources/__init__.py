"""Input tables and result hand-over."""

from .tables import COLUMNS, load_tables, missing_columns, write_bucketed, write_facts, write_model

__all__ = ["COLUMNS", "load_tables", "missing_columns", "write_bucketed", "write_facts", "write_model"]
