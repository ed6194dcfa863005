"""WARC archives over a chunked record table.

A payload is cut into rows of (record number, chunk number, text), at most ``chunk_chars`` code points each. A row carries
the digest of the payload up to its own end, so the last row of a record has the digest of the whole and no Python step
ever holds a whole oversized payload. Each chunk becomes one WARC record: the first a ``response``, the others
``continuation`` records with the standard's segment headers. Archives are gzip files written and read by Spark's text
source, so they may lie in any store that Spark reaches.

Null html is an empty payload. Rows with equal or null page_id are records of their own, told apart by a record number.
Columns other than page_id, url and html are ignored. An empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from loamwork.llm.common import partitions, query, stored, table
from loamwork.workspace import fresh_path

_END = "\r\n\r\n"
_VERSION = "WARC/1.1\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CHUNKS = "record_no bigint, page_id bigint, url string, chunk_no int, n_chunks int, data string, end_bytes bigint, digest string"
_RECORDS = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, n_segments int"


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _with_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Append the payload's size and digest up to each chunk. The chunks of a record come in order, one after the other."""
    running, size = hashlib.sha1(), 0
    for batch in batches:
        sizes, digests = [], []
        for number, data in zip(batch.column("chunk_no").to_pylist(), batch.column("data")):
            if number == 0:
                running, size = hashlib.sha1(), 0
            raw = data.as_py().encode()
            running.update(raw)
            size += len(raw)
            sizes.append(size)
            digests.append(_base32(running.digest()))
        columns = [*batch.columns, pa.array(sizes, pa.int64()), pa.array(digests, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "end_bytes", "digest"])


def chunk_table(pages: DataFrame, chunk_chars: int = 262_144) -> DataFrame:
    """Rows (record_no, page_id, url, chunk_no, n_chunks, data, end_bytes, digest), kept in the shared folder.

    ``end_bytes`` and ``digest`` cover the payload from its start to the end of the chunk.
    """
    length = F.length("html")
    chunks = (
        pages.select(F.col("page_id").cast("bigint"), "url", F.coalesce("html", F.lit("")).alias("html"))
        .withColumn("record_no", F.monotonically_increasing_id())
        .withColumn("n_chunks", F.greatest(F.ceil(length / chunk_chars), F.lit(1)).cast("int"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)).alias("chunk_no"))
        .select(
            "record_no", "page_id", "url", "chunk_no", "n_chunks",
            F.substring("html", F.col("chunk_no") * chunk_chars + 1, F.lit(chunk_chars)).alias("data"),
        )
    )
    return stored(chunks.mapInArrow(_with_digests, _CHUNKS), "warc-chunks")


def roles(chunks: DataFrame, min_bytes: int = 0) -> DataFrame:
    """One row per record: the response for its payload, or a revisit of the record with the largest page_id.

    Payloads below ``min_bytes`` are all responses. Equal page ids are told apart by the larger record number.
    """
    last = chunks.where(F.col("chunk_no") == F.col("n_chunks") - 1).select("record_no", "page_id", "end_bytes", "digest")
    kept = last.groupBy("digest").agg(F.max(F.struct("page_id", "record_no")).alias("kept"))
    first = (F.col("kept.record_no") == F.col("record_no")) | (F.col("end_bytes") < min_bytes)
    return last.join(kept, "digest").select(
        "record_no", "end_bytes", "digest", F.when(first, "response").otherwise("revisit").alias("record_type"),
        F.when(~first, F.col("kept.page_id")).alias("refers_to"), F.when(~first, F.col("kept.record_no")).alias("refers_no"),
    )


def _name(page_id, number, segment: int = 0) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{number}:{segment}>"


def _headers(pairs) -> str:
    return _VERSION + "".join(f"{k}: {v}\r\n" for k, v in pairs if v is not None) + "\r\n"


def _as_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The record of each chunk as text. A record's role row comes first, then its chunks in order."""
    role: dict = {}
    for batch in batches:
        out = []
        for row in (dict(zip(batch.schema.names, values)) for values in zip(*(c.to_pylist() for c in batch.columns))):
            if row["chunk_no"] < 0:
                role = row
                continue
            first, revisit, segments = row["chunk_no"] == 0, role["record_type"] == "revisit", row["n_chunks"]
            if revisit and not first:
                continue
            block = (_HTTP if first else "") + ("" if revisit else row["data"])
            segmented = segments > 1 and not revisit
            out.append(_headers([
                ("WARC-Type", role["record_type"] if first else "continuation"),
                ("WARC-Record-ID", _name(row["page_id"], row["record_no"], row["chunk_no"])),
                # Percent-escaped line ends: a url may not end its header line early.
                ("WARC-Target-URI", row["url"] and row["url"].replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")),
                ("WARC-Date", "2000-01-01T00:00:00Z"),
                ("Content-Type", "application/http; msgtype=response" if first else None),
                ("WARC-Payload-Digest", "sha1:" + role["digest"] if first else None),
                ("WARC-Profile", _PROFILE if revisit else None),
                ("WARC-Refers-To", _name(role["refers_to"], role["refers_no"]) if revisit else None),
                ("WARC-Segment-Number", row["chunk_no"] + 1 if segmented else None),
                ("WARC-Segment-Origin-ID", None if first else _name(row["page_id"], row["record_no"])),
                ("WARC-Segment-Total-Length", role["end_bytes"] + len(_HTTP) if segmented and row["chunk_no"] == segments - 1 else None),
                ("X-Payload-Length", role["end_bytes"] if first else None),
                ("Content-Length", len(block.encode())),
            ]) + block)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])


def write_archive(chunks: DataFrame, role: DataFrame, path: str, files: int | None = None) -> None:
    """Write gzip WARC files below ``path``. The segments of a record lie in one file, one after the other."""
    spark = chunks.sparkSession
    rows = chunks.select("record_no", "page_id", "url", "chunk_no", "n_chunks", "data").unionByName(
        role.withColumn("chunk_no", F.lit(-1)), allowMissingColumns=True
    )
    ordered = rows.repartition(files or partitions(spark), "record_no").sortWithinPartitions("record_no", "chunk_no")
    ordered.mapInArrow(_as_records, "value string").write.option("lineSep", _END).option("compression", "gzip").text(path)


def _number(name: str):
    found = name.split(":")[2]
    return int(found) if found else None


def _parse(pieces: Iterator[str]) -> Iterator[dict]:
    """Headers and block of each WARC record. The pieces lie between version lines, in the order of the file.

    A payload may itself hold a record end followed by a version line: the length tells that the block goes on.
    """
    for piece in pieces:
        head, _, block = piece.removeprefix(_VERSION).partition(_END)
        fields = dict(line.split(": ", 1) for line in head.split("\r\n"))
        raw, length = block.encode(), int(fields["Content-Length"])
        while len(raw) < length:
            raw += (_END + _VERSION + next(pieces)).encode()
        yield {"fields": fields, "block": raw[:length]}


def _as_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per page, its segments checked against the digest as they pass."""
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("n_segments", pa.int32()),
    ])
    current, running, size, done = None, hashlib.sha1(), 0, []

    def close():
        if current is None:
            return
        if current["record_type"] == "response" and (size, _base32(running.digest())) != (current["payload_bytes"], current["payload_digest"]):
            raise ValueError(f"payload of page {current['page_id']} differs from its digest")
        done.append(current)

    pieces = (value.as_py() for batch in batches for value in batch.column(0))
    for record in _parse(pieces):
        fields, block = record["fields"], record["block"]
        if fields["WARC-Type"] == "continuation":
            current["n_segments"] += 1
        else:
            close()
            if len(done) >= 1000:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
                done = []
            url, refers = fields.get("WARC-Target-URI"), fields.get("WARC-Refers-To")
            current = {
                "page_id": _number(fields["WARC-Record-ID"]),
                "url": url and url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
                "payload_bytes": int(fields["X-Payload-Length"]), "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                "record_type": fields["WARC-Type"], "refers_to": _number(refers) if refers else None, "n_segments": 1,
            }
            running, size, block = hashlib.sha1(), 0, block[len(_HTTP):]
        running.update(block)
        size += len(block)
    close()
    yield pa.RecordBatch.from_pylist(done, schema=schema)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per page: page_id, url, payload_bytes, payload_digest, record_type, refers_to, n_segments.

    gzip files are not split, so the segments of a record reach one task in order.
    """
    pieces = spark.read.schema("value string").option("lineSep", _END + _VERSION).text(path)
    return pieces.mapInArrow(_as_pages, _RECORDS)


@query("op8_warc")
def warc(spark: SparkSession, folder: str) -> DataFrame:
    chunks = chunk_table(table(spark, folder, "pages"))
    path = fresh_path(spark, "warc")
    write_archive(chunks, roles(chunks), path)
    return read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "n_segments")
