"""candleflow.sinks."""
