"""Exact duplicates, combined in three steps that no group of copies can overload.

Rows are equal if their normalised texts are. First every task drops the copies among its own rows
(a partial aggregate, before any shuffle). What is left is merged by digest and salt, so that a group
with a copy in every task is spread over SALTS tasks; then the salts' winners are combined. The keys
of all three steps hold the whole text beside its digest: rows meet only if their texts are equal.
Members learn their group's result by digest; if two texts ever shared one, by text.

Defined results: a NULL text is empty. The row with the smallest doc_id stays; NULL ids come
last, and a group of NULL ids only has keep_id NULL. Rows with the same doc_id and the same text are
one document: they are all kept or all not. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histload.llm.tables import lookup, stored

SALTS = 8
WHITE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def exact_duplicates(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs`` (doc_id, text)."""
    texts = docs.select("doc_id", normalised(F.col("text")).alias("norm"))
    texts = texts.select("doc_id", "norm", F.sha2("norm", 256).alias("digest"))
    # The salt is the task's, so a task's copies of a text are one row before the shuffle.
    salted = texts.withColumn("salt", F.pmod(F.hash(F.spark_partition_id()), F.lit(salts)))
    winners = salted.groupBy("digest", "salt", "norm").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    groups = winners.groupBy("digest", "norm").agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )
    groups = stored(groups.select("digest", "keep_id", "group_size"), "groups")
    members = texts.select("doc_id", "digest")
    if _shared_digest(groups):
        return _by_text(texts, winners)
    # Most texts are alone: only groups of several rows are looked up.
    copied = groups.where(F.col("group_size") > 1)
    total = copied.agg(F.sum("group_size")).first()[0] or 0
    rows = lookup(members, copied, ["digest"], F.col("group_size"), total)
    alone = F.col("group_size").isNull()
    rows = rows.withColumns(
        {
            "keep_id": F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")),
            "group_size": F.coalesce("group_size", F.lit(1)),
        }
    )
    return _result(rows)


def _shared_digest(groups: DataFrame) -> bool:
    """Whether two different texts have one digest."""
    return not groups.groupBy("digest").count().where("count > 1").isEmpty()


def _by_text(texts: DataFrame, winners: DataFrame) -> DataFrame:
    groups = winners.groupBy("digest", "norm").agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )
    return _result(texts.join(groups, ["digest", "norm"]))


def _result(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
