"""A PySpark-native engine for file corpora, their provenance and their analytics."""
