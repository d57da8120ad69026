"""DuckDB comparison queries, one text per registered query."""

from fungo.oracle.texts import oracle_texts

__all__ = ["oracle_texts"]
