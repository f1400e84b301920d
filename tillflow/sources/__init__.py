"""Readers: raw CSV days, gold Parquet days, message streams."""
