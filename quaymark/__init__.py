"""quaymark: a PySpark-native engine for moving live tables and proving that the copy is right."""
