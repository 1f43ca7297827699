"""A PySpark-native analytics engine for public-transport data."""
