"""Every operator as a query over the shared Parquet tables, with SQL to compare against."""
