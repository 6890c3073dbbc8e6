"""Listing analytics on Spark: ingest, archive, curate, aggregate, predict, report."""
