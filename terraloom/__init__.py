"""Spark-native integration of agricultural, environmental and livestock registers."""
