"""Spark-native event lakehouse: ingest, quality, incremental silver, keyed upsert."""
