"""Retail sales loading, cleaning, quality gate and reports as Spark jobs."""
