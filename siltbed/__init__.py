"""Exactly-once landing of partitioned message logs on Spark."""
