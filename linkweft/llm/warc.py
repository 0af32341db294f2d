"""WARC archives with an index: one gzip member per record, read back by byte ranges.

Writing stores the offset, length, URL and payload digest of every record in an index
table.  Reading takes index rows, sorts them by archive and offset, joins neighbouring
records into one range read, and checks every payload it returns.

Tasks write their archives through the file system of the shared folder, under names of
their own; the index rows of a task count only if Spark commits them, so the archive of a
failed or repeated task is never read.  Reading needs the index and the archives alone.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweft.llm.frames import new_folder, written

# Smallest payload that is stored once for several records.
SHARED_BYTES = 1000

# Bytes after which a task begins its next archive.
ARCHIVE_BYTES = 1 << 30

# Unread bytes that are read along rather than skipped, most bytes of one read, and bytes
# of an archive that are one piece of work.
GAP_BYTES = 64 << 10
READ_BYTES = 8 << 20
BLOCK_BYTES = 16 << 20

INDEX = "page_id long, url string, archive string, offset long, length long, payload_digest string, payload_bytes long, record_type string, refers_to long"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"


def write_archives(pages: DataFrame, folder: str | None = None) -> tuple[DataFrame, str]:
    """One record per row of `pages` (page_id, url, html); gives the written index and the folder.

    The payload is the html in UTF-8 (null: empty).  Of records with equal payloads of
    `SHARED_BYTES` or more, the one with the largest page_id is a response and the others
    revisit it; null ids are smallest, and rows with the same id and payload are all what
    their id is.  Other columns are not read.  No pages give an empty index.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    keyed = rows.withColumn("digest", F.sha1("payload")).withColumn("bytes", F.octet_length("payload").cast("long"))
    groups = keyed.where(F.col("bytes") >= SHARED_BYTES).groupBy("digest").agg(F.max("page_id").alias("last_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # a written table, so that Spark can split the rows of a digest that most pages have
    groups = written(groups, "copies")
    revisits = F.col("last_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last_id"))
    typed = keyed.join(groups, "digest", "left").select(
        "page_id",
        "url",
        "digest",
        "bytes",
        F.when(revisits, F.lit(None)).otherwise(F.col("payload")).alias("payload"),
        F.when(revisits, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(revisits, F.col("last_id")).alias("refers_to"),
    )
    index = typed.mapInArrow(_writer(f"{folder}/archives"), INDEX)
    index.write.parquet(f"{folder}/index")
    return spark.read.schema(index.schema).parquet(f"{folder}/index"), folder


def record_bytes(page_id: int | None, url: str | None, digest: str, payload: bytes | None, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; without a payload a revisit."""
    named = lambda k: f"<urn:linkweft:page:{'none' if k is None else k}>"
    address = "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (b"" if payload is None else f"Content-Length: {len(payload)}\r\n".encode()) + b"\r\n"
    block = http + (payload or b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if payload is not None else 'revisit'}",
        f"WARC-Record-ID: {named(page_id)}",
        *([f"WARC-Target-URI: {address}"] if address else []),
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
    ]
    if payload is None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {named(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields of one record, from its bytes."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    number = lambda name: None if fields.get(name, "none>").rsplit(":", 1)[-1] == "none>" else int(fields[name].rsplit(":", 1)[-1][:-1])
    return {
        "page_id": number("WARC-Record-ID"),
        "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "refers_to": number("WARC-Refers-To"),
        "payload_digest": base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex(),
        "payload": block.partition(b"\r\n\r\n")[2] if fields["WARC-Type"] == "response" else None,
    }


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        sink, name, offset = None, "", 0
        try:
            for batch in batches:
                found = []
                columns = [batch.column(c) for c in ("page_id", "url", "digest", "bytes", "payload", "record_type", "refers_to")]
                for k in range(batch.num_rows):
                    page_id, url, digest, size, payload, kind, refers_to = (c[k].as_py() for c in columns)
                    if sink is None or offset > ARCHIVE_BYTES:
                        if sink is not None:
                            sink.close()
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        sink = system.open_output_stream(f"{path}/{name}", compression=None)
                    member = gzip.compress(record_bytes(page_id, url, digest, payload, refers_to), 6, mtime=0)
                    sink.write(member)
                    found.append((page_id, url, name, offset, len(member), digest, size, kind, refers_to))
                    offset += len(member)
                yield _batch(found, INDEX)
        finally:
            if sink is not None:
                sink.close()

    return write


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split(" ") for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[kind]) for k, (_, kind) in enumerate(fields)], [n for n, _ in fields])


def read_records(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of the given index rows, read from the archives by joined byte ranges.

    A payload whose digest is not the record's raises an error.  A revisit record has no
    payload of its own: payload and payload_bytes are null; see `resolved`.  The number of
    tasks follows from the bytes to be read, not from those of the index.
    """
    asked = index.agg(F.sum("length")).first()[0] or 0
    ordered = (
        index.select("archive", "offset", "length", F.floor(F.col("offset") / BLOCK_BYTES).alias("block"))
        .repartition(1 + asked // BLOCK_BYTES, "archive", "block")
        .sortWithinPartitions("archive", "offset")
    )
    return ordered.mapInArrow(_reader(f"{folder}/archives", with_payload), RECORD)


def _reader(folder: str, with_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder)
        source, opened = None, None
        for batch in batches:
            spots = list(zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))))
            for name, start, end, part in _ranges(spots):
                if name != opened:
                    if source is not None:
                        source.close()
                    source, opened = system.open_input_file(f"{path}/{name}"), name
                held = source.read_at(end - start, start)
                found = []
                for _, offset, length in part:
                    record = parse_record(zlib.decompress(held[offset - start : offset - start + length], wbits=31))
                    payload = record.pop("payload")
                    if payload is not None and hashlib.sha1(payload).hexdigest() != record["payload_digest"]:
                        raise ValueError(f"{name} at {offset}: the payload is not what was written")
                    size = None if payload is None else len(payload)
                    found.append((*record.values(), size, payload if with_payload else None))
                yield _batch(found, RECORD)
        if source is not None:
            source.close()

    return read


def _ranges(spots: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list]]:
    """Neighbouring records as (archive, first byte, last byte + 1, records)."""
    part: list = []
    for spot in spots:
        name, offset, length = spot
        if part:
            first, last = part[0], part[-1]
            if name != first[0] or offset - (last[1] + last[2]) > GAP_BYTES or offset + length - first[1] > READ_BYTES:
                yield first[0], first[1], last[1] + last[2], part
                part = []
        part.append(spot)
    if part:
        yield part[0][0], part[0][1], part[-1][1] + part[-1][2], part


def resolved(index: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """All records of the index; revisits take payload and payload_bytes from their response."""
    responses = read_records(index.where("record_type = 'response'"), folder, with_payload)
    revisits = read_records(index.where("record_type = 'revisit'"), folder, False).drop("payload_bytes", "payload")
    wanted = (
        responses.where(F.col("payload_bytes") >= SHARED_BYTES)
        .groupBy(F.col("page_id").alias("refers_to"), "payload_digest")
        .agg(F.max("payload_bytes").alias("payload_bytes"), F.first("payload").alias("payload"))
    )
    # written, so that Spark can split the revisits of one response
    wanted = written(wanted, "responses")
    found = revisits.join(wanted, ["refers_to", "payload_digest"]).select(responses.columns)
    return responses.unionByName(found)
