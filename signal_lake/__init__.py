"""Content ingestion at scale, written as Spark DataFrame jobs."""
