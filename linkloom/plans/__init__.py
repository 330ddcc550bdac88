"""Composed jobs: the enrichment job and the query catalogue."""
