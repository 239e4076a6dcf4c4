"""A PySpark-native engine for listings quality, record linkage and text corpora."""
