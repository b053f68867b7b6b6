"""daylake: a catalog-driven, day-partitioned log lake on PySpark.

Raw daily TSV exports are checked, stored verbatim as string Parquet
partitions (``load_date=YYYY-MM-DD``), tracked by an append-only load
journal that is reconciled against the real partitions, and read back
through catalog-typed DataFrames / SQL views.
"""

__version__ = "0.1.0"
