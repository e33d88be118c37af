"""A Spark-native engine that prepares event tables for release, measures what they give away, and what they keep."""
