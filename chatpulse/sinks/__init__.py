"""Keyed result tables in Parquet, metric logs, and writers for outside stores."""
