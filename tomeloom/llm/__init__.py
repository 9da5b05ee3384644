"""Training-data operators: one module for each, plus their queries and SQL."""
