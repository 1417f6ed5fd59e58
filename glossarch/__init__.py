"""Spark-native engine for preparing text corpora for retrieval and knowledge extraction."""
