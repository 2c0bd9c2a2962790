"""A PySpark-native, read-only analytics bridge for relational sources."""
