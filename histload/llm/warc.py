"""WARC records in seekable Zstandard bundles.

Records are grouped into frames of about FRAME bytes, each compressed on its own, and frames into bundles. A
bundle ends with a seek table in a skippable frame (compressed and plain size of every frame, footer), so its
bytes are a ``.warc.zst`` file that any zstandard reader unpacks and seekable ones open anywhere. The index maps
each record's identifier to bundle, frame and offset inside the frame; one record costs reading one frame.

On disk, ``<path>/bundles`` is Parquet, so any store Spark can write will do: a row per frame, in the order of
the bundle, and one for its seek table. The ``data`` of a bundle's rows, joined by ``place``, is the file.
``<path>/index`` has a row per record. A frame holds whole records, so a longer record is a frame of its own.

Records with one payload are told by the SHA-256 of the whole payload: that with the largest page_id is written
as a response, the others as revisits that refer to it. Only digests and ids are shuffled to find them.

Defined results: a NULL html is an empty payload. A NULL page_id is smaller than any other. Rows that share payload and largest page_id are all responses, as
nothing tells them apart; they are equal records under one identifier. Control characters in a URL are percent-coded,
a NULL URL is left out of the header. An empty table gives files without rows. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histload.llm.tables import byte_size, lookup, maybe_broadcast, small_arrow_batches, stored
from histload.llm.words import small_batches

FRAME = 256 << 10  # bytes of records in a frame, unless one record has more
BUNDLE_FRAMES = 256
LEVEL = 3  # of zstandard
LEAST = 0  # shorter payloads are always written whole

# Fixed values of the seekable format: magic numbers of the skippable frame and of the footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
# Fixed values of WARC 1.1.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"  # a capture date where the rows have none

_FRAMES = "bundle string, place int, start long, data binary, records array<struct<record_id:string,page_id:{id_type},offset:int,length:int>>"
_READ = (
    "record_id string, page_id {id_type}, record_type string, refers_to_record string, "
    "refers_to {id_type}, payload_bytes long, payload_digest string, target_uri string, payload string"
)


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The skippable frame that lists (compressed, plain) sizes of the frames before it."""
    entries = b"".join(struct.pack("<II", *size) for size in sizes)
    footer = struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer


def frame_places(data: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of each frame, from the seek table that ends ``data``."""
    count, flags, magic = struct.unpack("<IBI", data[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    width = 12 if flags & 0x80 else 8
    begin = len(data) - 9 - width * count
    out, start = [], 0
    for n in range(count):
        packed, plain = struct.unpack_from("<II", data, begin + width * n)
        out.append((start, packed, plain))
        start += packed
    return out


def record_name(page_id, digest: bytes) -> str:
    """A record's identifier: a UUID made of its page_id and its payload's SHA-256."""
    key = hashlib.sha256(f"{'' if page_id is None else page_id}\n".encode() + digest).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=key[:16])}>"


def _clean(uri: str) -> str:
    return re.sub("[\x00-\x20\x7f]", lambda found: f"%{ord(found[0]):02X}", uri)


def record(page_id, url: str | None, payload: bytes, digest: bytes, lead=None, revisit: bool = False) -> bytes:
    """One WARC record. A revisit has the HTTP header only and names the response of ``lead``."""
    http = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        + b"Content-Length: %d\r\n\r\n" % len(payload)
    )
    block = http if revisit else http + payload
    lines = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_name(page_id, digest)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if page_id is not None:
        lines.append(("Page-ID", quote(str(page_id))))
    if url is not None:
        lines.append(("WARC-Target-URI", _clean(url)))
    if revisit:
        lines += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_name(lead, digest))]
        if lead is not None:
            lines.append(("Refers-To-Page-ID", quote(str(lead))))
    head = b"".join(f"{name}: {value}\r\n".encode() for name, value in lines)
    return b"%b\r\n%b\r\n%b\r\n\r\n" % (VERSION, head, block)


def parse_records(plain: bytes):
    """(offset, header as a dictionary, block) of each record of a frame."""
    offset = 0
    while offset < len(plain):
        end = plain.index(b"\r\n\r\n", offset)
        first, *lines = plain[offset:end].split(b"\r\n")
        if first != VERSION:
            raise ValueError(f"no record at {offset}")
        head = dict(line.decode().split(": ", 1) for line in lines)
        size = int(head["Content-Length"])
        yield offset, head, plain[end + 4 : end + 4 + size]
        offset = end + 4 + size + 4


class _Writer:
    """Rows (page_id, url, html, revisit, lead) of a partition to rows of bundles."""

    def __init__(self, schema: pa.Schema, frame: int, frames: int):
        self.schema, self.frame, self.frames = schema, frame, frames

    def __call__(self, batches):
        import zstandard

        compressor = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        task = TaskContext.get().partitionId()
        bundle, start, sizes = 0, 0, []
        waiting, records = bytearray(), []

        def row(data, entries):
            values = [f"{task:07d}-{bundle:06d}.warc.zst", len(sizes), start, data, entries]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], field.type) for v, field in zip(values, self.schema)], schema=self.schema
            )

        for batch in small_batches(batches, "html"):
            columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "html", "revisit", "lead"))
            for page_id, url, html, revisit, lead in zip(*columns):
                payload = (html or "").encode()
                digest = hashlib.sha256(payload).digest()
                raw = record(page_id, url, payload, digest, lead, revisit)
                if waiting and len(waiting) + len(raw) > self.frame:
                    data = compressor.compress(bytes(waiting))
                    yield row(data, records)
                    sizes.append((len(data), len(waiting)))
                    start += len(data)
                    waiting, records = bytearray(), []
                    if len(sizes) == self.frames:
                        yield row(seek_table(sizes), [])
                        bundle, start, sizes = bundle + 1, 0, []
                records.append(
                    {"record_id": record_name(page_id, digest), "page_id": page_id,
                     "offset": len(waiting), "length": len(raw)}
                )
                waiting += raw
        if waiting:
            data = compressor.compress(bytes(waiting))
            yield row(data, records)
            sizes.append((len(data), len(waiting)))
            start += len(data)
        if sizes:
            yield row(seek_table(sizes), [])


def _arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(ddl))


def _with_leads(pages: DataFrame, least: int) -> DataFrame:
    """``pages`` with ``lead``, the page_id of the response of its payload, and whether it is a ``revisit``."""
    body = F.coalesce("html", F.lit(""))
    marked = pages.withColumn("sha", F.when(F.octet_length(body) >= least, F.unhex(F.sha2(body, 256))))
    digests = marked.where(F.col("sha").isNotNull())
    groups = digests.groupBy("sha").agg(F.max("page_id").alias("lead"), F.count(F.lit(1)).alias("rows"))
    groups = stored(groups.where(F.col("rows") > 1), "payloads")
    width = byte_size(groups, F.lit(64) + F.coalesce(F.octet_length(F.col("lead").cast("string")), F.lit(0)))
    few = maybe_broadcast(groups, width)
    if few is groups:  # too many to broadcast; the most frequent payloads stay where they are
        total = groups.agg(F.sum("rows")).first()[0] or 0
        marked = lookup(marked, groups, ["sha"], F.col("rows"), total)
    else:
        marked = marked.join(few, "sha", "left")
    revisit = F.col("rows").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("lead"))
    return marked.select("page_id", "url", "html", revisit.alias("revisit"), F.when(revisit, F.col("lead")).alias("lead"))


def write_bundles(
    pages: DataFrame, path: str, least: int = LEAST, frame: int = FRAME, frames: int = BUNDLE_FRAMES
) -> None:
    """Write a record for each row of ``pages`` (page_id, url, html) and the index of the records.
    Of equal payloads of at least ``least`` bytes one is kept."""
    small_arrow_batches(pages.sparkSession)
    pages = pages.select("page_id", "url", "html")
    id_type = pages.schema["page_id"].dataType.simpleString()
    ddl = _FRAMES.format(id_type=id_type)
    rows = _with_leads(pages, least).mapInArrow(_Writer(_arrow_schema(ddl), frame, frames), ddl)
    rows.write.option("compression", "none").parquet(f"{path}/bundles")
    frames_ = pages.sparkSession.read.schema(ddl).parquet(f"{path}/bundles")
    entries = frames_.select("bundle", F.col("place").alias("frame"), F.explode("records").alias("record"))
    entries.select("record.record_id", "record.page_id", "bundle", "frame", "record.offset", "record.length").write.parquet(
        f"{path}/index"
    )


def _parsed(schema: pa.Schema, with_payload: bool):
    """Frames to their records. Digest and size are those of the payload read; of revisits there is none."""
    cast = {"page_id": schema.field("page_id").type}

    def typed(value, kind):
        value = value and unquote(value)
        return value if value is None or pa.types.is_string(kind) else int(value)

    def read(batches):
        import zstandard

        decompressor = zstandard.ZstdDecompressor()
        for batch in batches:
            for n, data in enumerate(batch.column("data")):
                plain = decompressor.decompress(data.as_buffer())
                wanted = batch.column("offsets")[n].as_py() if "offsets" in batch.schema.names else None
                rows = []
                for offset, head, block in parse_records(plain):
                    if wanted is not None and offset not in wanted:
                        continue
                    payload = block[block.index(b"\r\n\r\n") + 4 :]
                    whole = head["WARC-Type"] == "response"
                    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode() if whole else None
                    if whole and head["WARC-Payload-Digest"] != f"sha1:{digest}":
                        raise ValueError(f"damaged payload of {head['WARC-Record-ID']}")
                    rows.append((
                        head["WARC-Record-ID"], typed(head.get("Page-ID"), cast["page_id"]), head["WARC-Type"],
                        head.get("WARC-Refers-To"), typed(head.get("Refers-To-Page-ID"), cast["page_id"]),
                        len(payload) if whole else None, digest, head.get("WARC-Target-URI"),
                        payload.decode() if whole and with_payload else None,
                    ))
                columns = list(zip(*rows)) if rows else [()] * len(schema)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, field.type) for column, field in zip(columns, schema)], schema=schema
                )

    return read


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """(record_id, page_id, record_type, refers_to_record, refers_to, payload_bytes, payload_digest, target_uri,
    payload) of every record, from the frames. Size and digest of a revisit are those of its response."""
    frames = spark.read.parquet(f"{path}/bundles")
    id_type = spark.read.parquet(f"{path}/index").schema["page_id"].dataType.simpleString()
    ddl = _READ.format(id_type=id_type)
    data = frames.where(F.size("records") > 0).select("data")
    return data.mapInArrow(_parsed(_arrow_schema(ddl), with_payload), ddl)


def resolved(records: DataFrame) -> DataFrame:
    """``records`` of ``read_records`` in which revisits have size and digest of the response that they
    refer to."""
    records = stored(records.drop("payload"), "records")
    wanted = records.where(F.col("record_type") == "revisit")
    counts = wanted.groupBy("refers_to_record").agg(F.count(F.lit(1)).alias("rows"))
    response = records.where(F.col("record_type") == "response").select(
        F.col("record_id").alias("refers_to_record"),
        F.col("payload_bytes").alias("found_bytes"),
        F.col("payload_digest").alias("found_digest"),
    )
    response = response.dropDuplicates(["refers_to_record"]).join(counts, "refers_to_record")
    response = stored(response, "responses")
    total = response.agg(F.sum("rows")).first()[0] or 0
    wanted = lookup(wanted, response, ["refers_to_record"], F.col("rows"), total)
    wanted = wanted.withColumns(
        {"payload_bytes": F.col("found_bytes"), "payload_digest": F.col("found_digest")}
    ).select(*records.columns)
    return records.where(F.col("record_type") == "response").unionByName(wanted)


def fetch(spark: SparkSession, path: str, record_ids: list[str]) -> DataFrame:
    """The records with these identifiers, as ``read_records`` has them: the index tells their frames, and
    only these are read and unpacked."""
    index = spark.read.parquet(f"{path}/index").where(F.col("record_id").isin(record_ids))
    wanted = index.groupBy("bundle", F.col("frame").alias("place")).agg(F.collect_set("offset").alias("offsets"))
    places = [tuple(row) for row in wanted.collect()]  # as many as identifiers were given
    frames = spark.read.parquet(f"{path}/bundles")
    if not places:
        frames = frames.where("false")
    else:
        frames = frames.where(
            F.col("bundle").isin([p[0] for p in places]) & F.col("place").isin([p[1] for p in places])
        )
    frames = frames.join(F.broadcast(wanted), ["bundle", "place"]).select("data", "offsets")
    id_type = index.schema["page_id"].dataType.simpleString()
    ddl = _READ.format(id_type=id_type)
    return frames.mapInArrow(_parsed(_arrow_schema(ddl), True), ddl)
