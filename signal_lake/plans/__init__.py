"""Whole runs: registry transform, normalisation, ingestion."""
