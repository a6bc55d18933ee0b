"""Whole jobs (silver, gold, pipeline) and the query registry."""
