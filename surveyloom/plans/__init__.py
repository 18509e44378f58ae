"""Composed plans: pipelines and registered queries."""
