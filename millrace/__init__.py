"""Millrace: a Spark-native medallion analytics engine."""
