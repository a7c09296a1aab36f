"""Rental-listing analytics as Spark jobs: ingest, clean, model, rank and check."""
