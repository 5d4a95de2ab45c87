"""Column contracts: the schema and the column roles of every feed, kept as data.

Input is one row per (feed, column) - ``fp_id, col_name, col_datatype, col_ordinal,
primary_key_pos, is_defining_col, is_audit_col`` - and one row per feed - ``fp_id, file_format,
target_table_partition``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from histload.names import DELIMITED

# The type names a contract may use. The two patterns after the table are
# additions: decimals with precision and scale, and timestamps without time zone.
TYPE_DDL = {
    "ByteType": "tinyint",
    "ShortType": "smallint",
    "IntegerType": "int",
    "LongType": "bigint",
    "FloatType": "float",
    "DoubleType": "double",
    "DecimalType": "decimal(10,0)",
    "StringType": "string",
    "BinaryType": "binary",
    "TimestampType": "timestamp",
    "DateType": "date",
}
DECIMAL_PATTERN = r"^decimal\(\d+,\s*\d+\)$"
EXTRA_TYPE_DDL = {"TimestampNTZType": "timestamp_ntz"}


def type_ddl(name: Column) -> Column:
    """The DDL type of a contract type name, NULL if it is unknown."""
    ddl = F.when(name.rlike(DECIMAL_PATTERN), name)
    for contract_name, spark_type in {**TYPE_DDL, **EXTRA_TYPE_DDL}.items():
        ddl = ddl.when(name == contract_name, F.lit(spark_type))
    return ddl


def build_contracts(columns: DataFrame, feeds: DataFrame) -> DataFrame:
    """One row per feed: schema as DDL text, column roles in ordinal order, and ``problem``.

    Key: the columns whose ordinal equals their ``primary_key_pos``. Data (hashed): the columns
    not marked audit, without the keys. A feed that cannot be loaded says why in ``problem``.
    A feed's group is one table's column list; the rows are aggregated, never joined pairwise.
    """
    is_key = F.col("col_ordinal") == F.col("primary_key_pos")
    ddl = type_ddl(F.col("col_datatype"))
    quoted_name = F.concat(
        F.lit("`"), F.replace("col_name", F.lit("`"), F.lit("``")), F.lit("` ")
    )
    column = F.struct(
        F.col("col_ordinal").alias("ordinal"),
        F.col("col_name").alias("name"),
        F.col("col_datatype").alias("datatype"),
        F.concat(quoted_name, ddl).alias("ddl"),
        F.coalesce(is_key, F.lit(False)).alias("is_key"),
        F.coalesce(F.col("is_defining_col") == "Y", F.lit(False)).alias("is_defining"),
        F.coalesce((F.col("is_audit_col") == "N") & ~is_key, F.lit(False)).alias("is_data"),
    )
    per_feed = columns.groupBy("fp_id").agg(F.sort_array(F.collect_list(column)).alias("cols"))

    def names(test: Callable[[Column], Column]) -> Column:
        return F.filter("cols", test)["name"]

    unknown = names(lambda c: c["ddl"].isNull())
    roles = per_feed.select(
        "fp_id",
        F.when(F.size(unknown) == 0, F.array_join(F.col("cols")["ddl"], ", ")).alias("schema_ddl"),
        names(lambda c: c["is_key"]).alias("key_cols"),
        names(lambda c: c["is_defining"]).alias("defining_cols"),
        names(lambda c: c["is_data"]).alias("data_cols"),
        F.array_join(unknown, ", ").alias("unknown_types"),
    )
    partitions = F.split("target_table_partition", ",")
    problem = (
        F.when(
            F.col("file_format").isNull() | (F.col("file_format") != DELIMITED),
            F.concat(F.lit("file format is not "), F.lit(DELIMITED)),
        )
        .when(F.col("unknown_types").isNull(), F.lit("no columns in the contract"))
        .when(
            F.col("unknown_types") != "", F.concat(F.lit("unknown type for "), "unknown_types")
        )
        .when(F.size("key_cols") == 0, F.lit("no key column"))
        .when(F.size("defining_cols") == 0, F.lit("no defining column"))
        .when(F.col("target_table_partition").isNull(), F.lit("no partition column"))
    )
    return (
        feeds.join(roles, "fp_id", "left")
        .withColumns(
            {
                "key_col": F.get("key_cols", F.lit(0)),
                "defining_col": F.get("defining_cols", F.lit(0)),
                "partition_cols": partitions,
                "partition_col": F.get(partitions, F.lit(0)),
                "problem": problem,
            }
        )
        .drop("unknown_types", "target_table_partition")
    )


def schema_for(contract: Row) -> StructType:
    """The schema of one feed, all columns nullable; an unusable contract raises its problem."""
    if contract["problem"] is not None:
        raise ValueError(contract["problem"])
    return StructType.fromDDL(contract["schema_ddl"])


def with_contract(files: DataFrame, contracts: DataFrame) -> DataFrame:
    """File-log rows with their feed's contract; files of an unknown feed get a ``problem``."""
    known = contracts.withColumn("__known", F.lit(True))
    problem = F.when(F.col("__known").isNull(), F.lit("unknown feed")).otherwise(F.col("problem"))
    return files.join(known, "fp_id", "left").withColumn("problem", problem).drop("__known")
