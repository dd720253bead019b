"""Assembled pipelines (flagship velocity, full feature build) and the query registry."""
