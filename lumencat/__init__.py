"""Spark-native galaxy-catalogue analytics: DataFrame in, DataFrame out."""
