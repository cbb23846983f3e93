"""Warehouse building on Spark DataFrames: ingest, cleanse, model, load, check."""
