"""Spark-native analytics on keyed, labelled time series."""
