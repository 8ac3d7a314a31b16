"""Writers: Parquet tables, topics and JDBC."""
