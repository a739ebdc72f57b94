"""Spark-native analytics over daily snapshot tables: lifecycle, tagging, demand marts, reports, checks."""
