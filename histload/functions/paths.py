"""Where a registered file lies, and which history table it feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The path scheme, the bucket rename and the batch suffix of file names.
SCHEME = "s3a://"
LANDING, RAW = "landing", "raw"
BATCH_SUFFIX = r"_\d+.csv"
TABLE_SUFFIX = ".parquet"


def source_path(bucket: Column, filename: Column, scheme: str = SCHEME) -> Column:
    return F.concat(F.lit(scheme), bucket, F.lit("/"), filename)


def target_path(bucket: Column, filename: Column, scheme: str = SCHEME) -> Column:
    """``landing/in/sales_20240101.csv`` feeds ``raw/sales.parquet``."""
    table = F.regexp_replace(F.element_at(F.split(filename, "/"), -1), BATCH_SUFFIX, "")
    raw_bucket = F.replace(bucket, F.lit(LANDING), F.lit(RAW))
    return F.concat(F.lit(scheme), raw_bucket, F.lit("/"), table, F.lit(TABLE_SUFFIX))


def with_paths(files: DataFrame, scheme: str = SCHEME) -> DataFrame:
    """Add ``source_path`` and ``target_path`` to file-log rows (``bucket_name``, ``filename``)."""
    bucket, name = F.col("bucket_name"), F.col("filename")
    return files.withColumns(
        {
            "source_path": source_path(bucket, name, scheme),
            "target_path": target_path(bucket, name, scheme),
        }
    )
