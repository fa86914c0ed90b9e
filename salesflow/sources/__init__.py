from salesflow.sources.jdbc import read_jdbc
from salesflow.sources.readers import read_block_report, read_csv, read_json, read_parquet
from salesflow.sources.sinks import export_dataset, write_csv, write_json, write_parquet

__all__ = ["export_dataset", "read_block_report", "read_csv", "read_jdbc", "read_json", "read_parquet",
           "write_csv", "write_json", "write_parquet"]
