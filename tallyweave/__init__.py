"""Record linkage and data preparation on Spark."""
