"""Spark building blocks for landing, cleaning, enriching and indexing JSON records."""
