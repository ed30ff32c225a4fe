"""candleflow.operators."""
