"""Reading bronze JSON, reading and writing the Parquet tables, and where scratch data goes."""
