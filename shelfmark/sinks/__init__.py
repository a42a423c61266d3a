"""Writers: Parquet, CSV and JDBC tables."""
