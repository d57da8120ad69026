"""Readers, the partitioned landing and the raw tables derived from the driver's data."""
