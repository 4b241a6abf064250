"""Connectors: landed records in, the common raw item schema out."""
