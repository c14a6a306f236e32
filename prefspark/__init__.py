"""Spark jobs that refine instruction/response preference data."""
