"""strata: Spark-native tabular feature and binary-classification analytics."""
