"""Queries over recorded session event logs, expressed as Spark plans."""
