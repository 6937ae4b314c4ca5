from .delimited import land_csv, read_text_csv, typed
from .tables import read_parquet, read_table

__all__ = ["land_csv", "read_parquet", "read_table", "read_text_csv", "typed"]
