"""Spark-native validation of gridded earth-observation products, with a training-data subpackage."""
