"""cairn: a PySpark-native engine for keyed analytical tables."""
