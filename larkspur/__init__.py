"""Spark-native feature engineering, enrichment, modelling and reporting."""
