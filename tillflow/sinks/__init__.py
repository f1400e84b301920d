"""Writers: gold Parquet with the row count taken from the write itself, and log tables."""
