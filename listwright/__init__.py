"""Listing analytics on Spark: pages to curated, scored and stored listing tables."""
