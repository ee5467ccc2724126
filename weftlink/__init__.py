"""Spark-native record linkage and data profiling."""
