"""Readers and writers: JSON snapshots, window Parquet files, CSV dimensions, catalog."""
