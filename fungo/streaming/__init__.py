"""Incremental ingestion by a file stream."""
