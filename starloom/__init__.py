"""starloom: Spark-native ELT and star-schema analytics."""
