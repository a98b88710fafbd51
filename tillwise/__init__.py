"""Spark-native retail analytics: DataFrame in, DataFrame out."""
