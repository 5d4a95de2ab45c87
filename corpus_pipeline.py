"""From raw documents to training blocks: five stages, each written and read again by the next.

Toxic documents go, one document of each class of near-duplicates stays, documents with benchmark
passages go, sources are mixed to target weights (documents repeat as often as the mix takes them),
and the rest is encoded and written as bit-plane blocks of token ids.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histload.llm import decontamination, mixing, ordered_minhash, token_files, toxicity
from histload.llm.tables import byte_size, checkpointed, maybe_broadcast
from histload.names import quoted
from histload.session import scratch_path

KEY_BYTES = 48  # of the hash of a document's text and what a broadcast row holds beside the id


def _with_free_names(docs: DataFrame, step) -> DataFrame:
    """``step`` of ``docs``, whose columns it does not read have names that clash with none of its own."""
    read = ("doc_id", "text", "source")
    free = {n: n if n in read else f"passed_{i}" for i, n in enumerate(docs.columns)}
    out = step(docs.select(*(F.col(quoted(n)).alias(name) for n, name in free.items())))
    return out.select(*(F.col(name).alias(n) for n, name in free.items()))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5, by a model of the labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels)
    return _with_free_names(docs, lambda rows: toxicity.score(rows, model).where(F.col("score") < 0.5))


def _of_keys(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """``docs`` semi- or anti-joined with different (doc_id, text_hash); broadcast if few."""
    keys = keys.select(F.col("doc_id").alias("key_id"), F.col("text_hash").alias("key_hash"))
    width = F.lit(KEY_BYTES) + F.coalesce(F.octet_length(F.col("key_id").cast("string")), F.lit(0))
    keys = maybe_broadcast(keys, byte_size(keys, width))
    same = docs["doc_id"].eqNullSafe(F.col("key_id")) & (F.xxhash64(docs["text"]) == F.col("key_hash"))
    return docs.join(keys, same, how)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that with the smallest id."""
    kept = ordered_minhash.near_duplicates(docs).where("kept")
    kept = checkpointed(kept.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows")))
    repeated = kept.where(F.col("rows") > 1)

    def of_kept(rows: DataFrame) -> DataFrame:
        if repeated.isEmpty():
            return _of_keys(rows, kept, "left_semi")
        once = _of_keys(rows, kept.where(F.col("rows") == 1), "left_semi")
        return once.unionByName(_of_keys(rows, repeated, "left_semi").dropDuplicates(["doc_id", "text"]))

    return _with_free_names(docs, of_kept)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hit = decontamination.contaminated(docs, benchmark).where(F.col("n_hit") > 0)
    hit = checkpointed(hit.select("doc_id", "text_hash").distinct())
    return _with_free_names(docs, lambda rows: _of_keys(rows, hit, "left_anti"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every time the mix takes a document, shard by shard, shuffled inside each."""
    return _with_free_names(docs, lambda rows: mixing.in_shards(mixing.mixed(rows)))


def _in_file_order(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` (doc_id, text) with columns that give the order in which its files hold them: number of the
    partition that wrote the file, name of the file, row. Rows that come from no files have no such order."""
    try:
        place = docs.metadataColumn("_metadata")
        name = place["file_name"]
        rows = docs.select(
            "doc_id",
            "text",
            F.regexp_extract(name, r"^part-(\d+)", 1).try_cast("long").alias("part"),
            name.alias("file"),
            place["row_index"].alias("row"),
        )
        return rows, ["part", "file", "row"]
    except AnalysisException:
        return docs.select("doc_id", "text"), []


def write_token_blocks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all rows, written to files in the order of the mix; the rows are what the files hold."""
    path = scratch_path(spark, "pipeline_tokens")
    rows, order = _in_file_order(docs)
    token_files.write_tokens(rows, path, order=order)
    return token_files.read_documents(spark, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_blocks", write_token_blocks),
]

# The stages learn, sketch, draw and encode; SQL cannot. Tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
