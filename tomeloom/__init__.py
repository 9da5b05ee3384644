"""Document structure and concept extraction on Spark, with operators for training data."""
