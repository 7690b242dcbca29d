"""Readers and writers."""

from tripledger.sources.csv_files import read_csv, write_csv
from tripledger.sources.parquet_tables import materialize, read_parquet, write_parquet

__all__ = ["materialize", "read_csv", "read_parquet", "write_csv", "write_parquet"]
