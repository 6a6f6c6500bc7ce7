"""Spark-native analytics over documents, runs and embeddings."""
