"""A Spark library for raw records, their evidence, and training data."""
