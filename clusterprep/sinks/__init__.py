"""Result sinks: Parquet folders, catalog tables and JDBC tables."""
