"""Sources: Parquet/CSV/JDBC readers with explicit schemas, page tables,
column catalogues and parameter grids."""
