"""Delimited text files read with a contract's schema."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from histload.names import quoted

LOOKUP_BYTES = 64 << 20


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType | str,
    check_header: bool = False,
    unparsable: str | None = None,
) -> DataFrame:
    """All files in one scan. Column positions decide, header names are skipped; with
    ``check_header`` a header that differs from the schema fails the read. Text that does not
    fit a column's type becomes NULL; a column named ``unparsable`` then holds the whole line (NULL in
    rows that fit), as it does for lines with too few or too many fields."""
    reader = spark.read.option("header", True).option("enforceSchema", not check_header)
    if unparsable is not None:
        schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        schema = StructType([*schema.fields, StructField(unparsable, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", unparsable)
    rows = reader.schema(schema).csv([paths] if isinstance(paths, str) else list(paths))
    if unparsable is None:
        return rows
    # A column nobody asks for is not parsed, and would fit; this condition, which always holds, asks for all.
    every = [F.col(quoted(name)) for name in rows.columns if name != unparsable]
    return rows.where(F.xxhash64(*every) >= F.lit(-(2**63)))


def read_numbered(
    spark: SparkSession,
    files: Sequence[tuple[str, int]],
    schema: StructType | str,
    number: str,
    check_header: bool = False,
    unparsable: str | None = None,
) -> DataFrame:
    """One scan over (path, number) files; every row carries its file's number.

    A path may be a folder, as Spark writes one per data set. The numbers are looked up by the
    file name Spark gives each row, in a broadcast table with one row per file of the scan. Its
    size is known here; if it exceeds LOOKUP_BYTES, the files are read in several scans.
    """
    rows = read_delimited(spark, [path for path, _ in files], schema, check_header, unparsable)
    numbers = {_plain(path): place for path, place in files}
    # Rows name a local file with one slash after the scheme, the list of files with three.
    located = [
        (re.sub("^file:/+", "file:/", file), _number_of(file, numbers))
        for file in rows.inputFiles()
    ]
    if len(files) > 1 and sum(len(file) + 64 for file, _ in located) > LOOKUP_BYTES:
        halves = files[: len(files) // 2], files[len(files) // 2 :]
        parts = [read_numbered(spark, half, schema, number, check_header, unparsable) for half in halves]
        return parts[0].union(parts[1])
    lookup = F.broadcast(spark.createDataFrame(located, f"__file string, {number} int"))
    unknown = F.raise_error(F.concat(F.lit("row of an unregistered file: "), "__file"))
    names = [quoted(name) for name in rows.columns]
    return (
        rows.withColumn("__file", F.col("_metadata.file_path"))
        .join(lookup, "__file", "left")
        .select(*names, F.coalesce(number, unknown.cast("int")).alias(number))
    )


def _plain(path: str) -> str:
    """A path without the local scheme and without a slash at the end."""
    return re.sub("^file:/+", "/", path).rstrip("/")


def _number_of(file: str, numbers: dict[str, int]) -> int:
    """The number of the registered path that is ``file`` or a folder above it."""
    path = _plain(unquote(file))
    while path:
        if path in numbers:
            return numbers[path]
        path = path.rpartition("/")[0]
    raise ValueError(f"no registered path for {file}")
