"""Spark-native identity resolution, audience analytics and training-data preparation."""
