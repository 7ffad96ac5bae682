"""PySpark-native engine for public-document corpora."""
