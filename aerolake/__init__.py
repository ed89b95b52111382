"""aerolake: Spark-native ingest, validation and idempotent upsert of positional state vectors."""

__version__ = "0.1.0"
