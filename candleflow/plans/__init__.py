"""candleflow.plans."""
