"""A PySpark-native engine that prepares document corpora."""
