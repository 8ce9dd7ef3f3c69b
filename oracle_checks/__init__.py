"""Independent SQL for every registered query, run by a second engine on the same files."""

from .sql import oracle_queries

__all__ = ["oracle_queries"]
