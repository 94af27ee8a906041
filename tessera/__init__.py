"""Tessera: a Spark-native engine that turns research documents into a queryable knowledge graph."""
