"""Taxonomies, interactions and traits as one triple table on Spark."""
