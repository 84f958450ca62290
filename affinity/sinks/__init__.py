"""Writers: parquet, tables, JDBC, messages, console."""
