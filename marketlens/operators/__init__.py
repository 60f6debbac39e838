"""User-level operators Spark lacks as a single call: distributed global
ranking and data-quality checks."""
