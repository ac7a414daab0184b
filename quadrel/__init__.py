"""PySpark-native knowledge-graph analytics."""
