"""Readers, the partitioned warehouse and the metric store."""
