"""Drought-sensitivity scoring of stream networks as Spark DataFrame jobs."""
