"""A Spark-native engine that builds, joins, validates and exports training data."""
