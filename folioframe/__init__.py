"""A PySpark-native analytics library for records of repeated fields and for tables."""
