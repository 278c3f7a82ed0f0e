"""Geospatial and tabular DataFrame operators for Spark, and five pipelines made of them."""
