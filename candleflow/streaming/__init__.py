"""candleflow.streaming."""
