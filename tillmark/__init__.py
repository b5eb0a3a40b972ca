"""Incremental retail analytics on PySpark: raw CSV drops to bronze, silver, gold and report queries."""
