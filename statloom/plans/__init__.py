"""Aggregation plans shared by several operators, and the catalogue of queries."""
