"""candleflow.sources."""
