"""Composed jobs: the raw-to-gold medallion and the query catalogue."""
