"""Spark-native analytics over market texts and the knowledge graph built from them."""
