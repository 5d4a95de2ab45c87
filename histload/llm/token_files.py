"""Token ids in files of bit-plane-shuffled blocks.

Documents are sorted by id over the whole table, or by columns that give another order; the sorted
partitions are the shards. A shard's ids, each document's closed by an end id, are cut into blocks of
BLOCK ids (the last may be shorter). A block is transposed: all lowest bits, then all next bits, and so on (or bytes), each
plane compressed with zstandard on its own. Constant planes, as the high bits often are, shrink to
almost nothing.

On disk, ``<path>/blocks`` is Parquet, so any store Spark can write will do: one row per block with
its planes as binary values and the documents that begin in it. ``<path>/index`` is the index of the
blocks: shard, number, place of the first id among all ids, ids, documents, bytes.

Defined results: a NULL or empty text has the end id only. Documents with a NULL doc_id come
first; rows with one doc_id are ordered by text, and equal rows are written as often as they
occur. An empty table gives files without rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from histload.llm.encoding import encoder
from histload.llm.tables import small_arrow_batches
from histload.llm.words import small_batches, text_bytes
from histload.names import quoted

END_ID = 2
BLOCK = 1 << 16
LEVEL = 3  # of zstandard

_BLOCKS = (
    "shard int, block long, first long, n_ids int, begun long, open boolean, unit int, "
    "doc_ids array<{id_type}>, starts array<int>, planes array<binary>"
)
_PIECES = "shard int, number long, doc_id {id_type}, first long, n_ids long, crc long, ids binary"


def pack(ids: np.ndarray, unit: int = 1) -> list[bytes]:
    """Planes of ``unit`` bits (1 or 8) of a block, lowest first, compressed."""
    import zstandard

    compressor = zstandard.ZstdCompressor(level=LEVEL)
    width = max(1, int(ids.max()).bit_length()) if len(ids) else 0
    own = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if unit == 8:
        return [compressor.compress(own[n].tobytes()) for n in range((width + 7) // 8)]
    bits = (np.packbits(own[n // 8] & np.uint8(1 << n % 8)) for n in range(width))
    return [compressor.compress(plane.tobytes()) for plane in bits]


def unpack(planes: list[bytes], count: int, unit: int = 1) -> np.ndarray:
    """The ids of a block."""
    import zstandard

    decompressor = zstandard.ZstdDecompressor()
    own = np.zeros((4, count), np.uint8)
    for n, plane in enumerate(planes):
        raw = np.frombuffer(decompressor.decompress(plane), np.uint8)
        if unit == 8:
            own[n] = raw
        else:
            own[n // 8] |= np.unpackbits(raw, count=count) << np.uint8(n % 8)
    return np.ascontiguousarray(own.T).view("<u4").ravel()


class _Writer:
    """Sorted (doc_id, text) batches of a partition to its block rows."""

    def __init__(self, tokenizer: str | None, end_id: int, block: int, unit: int, schema: pa.Schema):
        self.tokenizer, self.end_id, self.block, self.unit = tokenizer, end_id, block, unit
        self.schema = schema

    def __call__(self, batches):
        encode = encoder(self.tokenizer).ids_of
        end = np.array([self.end_id], "<u4").tobytes()
        size = 4 * self.block
        shard = TaskContext.get().partitionId()
        waiting, doc_ids, starts = bytearray(), [], []
        blocks = begun = 0

        def row(raw, last):
            here = [n for n, start in enumerate(starts) if start < len(raw)]
            ids = np.frombuffer(raw, "<u4")
            values = [
                shard, blocks, blocks * self.block, len(ids), begun, last, self.unit,
                [doc_ids[n] for n in here], [starts[n] // 4 for n in here], pack(ids, self.unit),
            ]
            columns = [pa.array([v], field.type) for v, field in zip(values, self.schema)]
            return pa.RecordBatch.from_arrays(columns, schema=self.schema), len(here)

        for batch in small_batches(batches, "text"):
            raw, offsets = text_bytes(batch.column("text"))
            data, ids = raw.tobytes(), batch.column("doc_id").to_pylist()
            encoded = encode([data[a:b] for a, b in zip(offsets[:-1], offsets[1:])])
            for doc_id, own in zip(ids, encoded):
                doc_ids.append(doc_id)
                starts.append(len(waiting))
                waiting += own
                waiting += end
                while len(waiting) >= size:
                    # A block is open if its last document goes on in the next.
                    out, count = row(bytes(waiting[:size]), len(waiting) > size)
                    yield out
                    blocks, begun = blocks + 1, begun + count
                    del waiting[:size]
                    doc_ids, starts = doc_ids[count:], [start - size for start in starts[count:]]
        if waiting:
            yield row(bytes(waiting), False)[0]


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    block: int = BLOCK,
    unit: int = 1,
    order: Sequence[str] = (),
) -> None:
    """Encode and write ``docs`` (doc_id, text). ``tokenizer``: a file on every executor. ``order``: columns
    by which the documents are written (in ascending order, ties by id); by id alone if there are none."""
    spark = docs.sparkSession
    small_arrow_batches(spark)
    first = [F.col(quoted(name)).alias(f"order_{n}") for n, name in enumerate(order)]
    ordered = docs.select(*first, "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # The text's hash parts rows of one id, should an id have very many.
    by = [*(f"order_{n}" for n in range(len(first))), "doc_id", F.xxhash64("text")]
    ordered = ordered.repartitionByRange(*by).sortWithinPartitions(*by, "text").select("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType
    ddl = _BLOCKS.format(id_type=id_type.simpleString())
    schema = _arrow_schema(spark, ddl)
    writer = _Writer(tokenizer, end_id, block, unit, schema)
    ordered.mapInArrow(writer, ddl).write.option("compression", "none").parquet(f"{path}/blocks")

    blocks = spark.read.schema(ddl).parquet(f"{path}/blocks")
    width = F.aggregate("planes", F.lit(0), lambda n, plane: n + F.octet_length(plane))
    index = blocks.select(
        "shard", "block", "first", "n_ids", F.size("doc_ids").alias("n_docs"), width.alias("bytes")
    )
    shards = _shard_starts(index)
    index.join(shards, "shard").select(
        "shard", "block", (F.col("shard_start") + F.col("first")).alias("start"), "n_ids", "n_docs", "bytes"
    ).write.parquet(f"{path}/index")


def _arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(ddl))


def _shard_starts(index: DataFrame) -> DataFrame:
    """(shard, shard_start): ids in earlier shards. One row per shard, so a plain window."""
    sums = index.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(
        "shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("shard_start")
    )


def _read_blocks(schema: pa.Schema):
    """Block rows to pieces of documents: whole ones with their checksum, others with their ids."""

    def pieces(batches):
        for batch in batches:
            rows = [row for block in batch.to_pylist() for row in _pieces(block)]
            columns = list(zip(*rows)) if rows else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, field.type) for column, field in zip(columns, schema)],
                schema=schema,
            )

    return pieces


def _pieces(block: dict):
    raw = unpack(block["planes"], block["n_ids"], block["unit"]).astype("<u4").tobytes()
    cuts = [*block["starts"], block["n_ids"]]
    if cuts[0]:  # the end of a document of an earlier block
        ids = raw[: 4 * cuts[0]]
        yield block["shard"], block["begun"] - 1, None, block["first"], cuts[0], None, ids
    for n, doc_id in enumerate(block["doc_ids"]):
        ids = raw[4 * cuts[n] : 4 * cuts[n + 1]]
        whole = n + 1 < len(block["doc_ids"]) or not block["open"]
        yield (
            block["shard"], block["begun"] + n, doc_id, block["first"] + cuts[n], len(ids) // 4,
            zlib.crc32(ids) if whole else None, None if whole else ids,
        )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files; ``start`` is the number
    of ids before it. Only pieces of documents that lie in several blocks are shuffled."""
    blocks = spark.read.parquet(f"{path}/blocks")
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    ddl = _PIECES.format(id_type=id_type)
    pieces = blocks.mapInArrow(_read_blocks(_arrow_schema(spark, ddl)), ddl)
    shards = _shard_starts(spark.read.parquet(f"{path}/index"))
    whole = pieces.where(F.col("crc").isNotNull()).select("shard", "doc_id", "first", "n_ids", "crc")
    parts = F.array_sort(F.collect_list(F.struct("first", "ids")))
    split = pieces.where(F.col("crc").isNull()).groupBy("shard", "number").agg(
        F.max("doc_id").alias("doc_id"),
        F.min("first").alias("first"),
        F.sum("n_ids").alias("n_ids"),
        parts.alias("parts"),
    )
    joined = F.unhex(F.array_join(F.transform("parts", lambda part: F.hex(part["ids"])), ""))
    split = split.select("shard", "doc_id", "first", "n_ids", F.crc32(joined).alias("crc"))
    return (
        whole.union(split)
        .join(shards, "shard")
        .select(
            "doc_id",
            (F.col("shard_start") + F.col("first")).alias("start"),
            F.col("n_ids").alias("n_tokens"),
            F.col("crc").alias("ids_crc32"),
        )
    )
