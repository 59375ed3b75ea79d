"""A PySpark-native engine for document-layout analytics."""
