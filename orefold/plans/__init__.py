"""The pipelines: silver, gold, serving, dimension and ingest."""
