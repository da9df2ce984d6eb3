"""Quorum: a Spark-native analytics engine for civic data."""
