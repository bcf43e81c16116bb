"""Snapshot analytics for sales stages, expressed as Spark DataFrame jobs."""
