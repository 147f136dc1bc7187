"""Text preparation for language-model training, on Spark."""
