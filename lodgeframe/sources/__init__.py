"""Table sources: raw Parquet tables, stand-in relational views, files."""
