"""Post-training data and evaluation jobs as Spark DataFrame operators."""
