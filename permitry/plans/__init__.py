"""Whole jobs: ingest, clean, harmonise, trends."""
