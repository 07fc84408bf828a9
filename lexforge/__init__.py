"""A PySpark-native engine that turns text corpora into ranked word lists."""
