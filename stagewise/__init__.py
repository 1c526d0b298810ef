"""Staged-load engine on PySpark: merge, upsert, type enforcement, watermarks, run log."""
