"""Retail transaction pipeline on Spark: raw records in, clean tables and reports out."""
