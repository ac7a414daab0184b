"""WARC archives: write, normalise a monolithic gzip stream, read back by offset.

A WARC file compressed as one gzip stream can be read only from its start.  The
normaliser inflates such a stream once, in order and in pieces of bounded size, cuts it
into records by their Content-Length, writes every record as a gzip member of its own
and notes each member's offset in a sidecar index.  Any record can then be read alone.

Archives are real files below a folder that all executors share, reached through
``pyarrow.fs`` so that the folder may be any store it knows.  A task writes its archive
under its partition's name and moves it into place when it is whole; a task that runs
again writes the same bytes again.

Defined cases: null html is an empty payload; very long html is written and inflated in
bounded pieces; other columns are ignored; payloads shorter than ``least`` bytes are
always responses; null page ids are always responses; of equal payloads the page with the smallest id is the
response and, between wholly repeated rows, each row that has that id is a
response; null urls become ``urn:page:<id>``; an empty table gives no archive and an
empty result.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrel.llm.shared import scratch_path, text_of, written

PIECE = 1 << 18
#: A table of revisits below this many rows (16 bytes each) is broadcast; beyond, it is joined by shuffle.
BROADCAST_ROWS = 500_000
STAMP = "2024-01-01T00:00:00Z"
INDEX_SCHEMA = "archive string, offset long, length long, record_type string, page_id long, payload_bytes long, payload_digest string, refers_to long"


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record: a response, or a revisit that carries the HTTP header alone."""
    digest = hashlib.sha256(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    uri = "".join(c if c > " " else "%%%02X" % ord(c) for c in url) if url else f"urn:page:{page_id}"
    kind = "response" if refers_to is None else "revisit"
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {uri} {digest}')}>",
        f"WARC-Date: {STAMP}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Page-Id: {'' if page_id is None else page_id}",
    ]
    if refers_to is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"X-Refers-To-Page-Id: {refers_to}")
    block = http if refers_to is not None else http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def split_records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Cut a stream of inflated bytes into whole records by their Content-Length."""
    held = bytearray()
    at, need = 0, -1
    for piece in pieces:
        held += piece
        while True:
            if need < 0:
                end = held.find(b"\r\n\r\n", at)
                if end < 0:
                    break
                fields = parse_head(bytes(held[at:end]))
                need = end + 4 - at + int(fields["content-length"]) + 4
            if len(held) - at < need:
                break
            yield bytes(held[at : at + need])
            at, need = at + need, -1
        if at:
            del held[:at]
            at = 0
    if held.strip():
        raise ValueError("the archive ends within a record")


def parse_head(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name, without the version line."""
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


def inflate(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Inflate a gzip stream of one or more members, a bounded piece at a time."""
    unzip = zlib.decompressobj(31)
    for chunk in chunks:
        while chunk:
            out = unzip.decompress(chunk, PIECE)
            if out:
                yield out
            if unzip.eof:
                chunk = unzip.unused_data
                unzip = zlib.decompressobj(31)
            else:
                chunk = unzip.unconsumed_tail
    out = unzip.flush()
    if out:
        yield out


def _chunks(handle) -> Iterator[bytes]:
    while data := handle.read(PIECE):
        yield data


def _member(data: bytes, level: int) -> bytes:
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def write_monolith(fs: pafs.FileSystem, path: str, records: Iterator[bytes], level: int = 1) -> int:
    """Write all records as one gzip stream; the number of records."""
    pack, n = zlib.compressobj(level, zlib.DEFLATED, 31), 0
    with fs.open_output_stream(path, compression=None) as out:
        for record in records:
            out.write(pack.compress(record))
            n += 1
        out.write(pack.flush())
    return n


def normalise(fs: pafs.FileSystem, source: str, target: str, level: int = 6) -> list[dict]:
    """Rewrite ``source`` with one gzip member for each record; write ``target`` and its index."""
    entries, offset = [], 0
    with fs.open_input_stream(source, compression=None) as raw, fs.open_output_stream(target + ".part", compression=None) as out:
        for record in split_records(inflate(_chunks(raw))):
            member = _member(record, level)
            out.write(member)
            entries.append({"offset": offset, "length": len(member)} | describe(record))
            offset += len(member)
    with fs.open_output_stream(target + ".idx.part", compression=None) as out:
        out.write("".join(json.dumps(x) + "\n" for x in entries).encode())
    fs.move(target + ".idx.part", target + ".idx")
    fs.move(target + ".part", target)
    return entries


def describe(record: bytes) -> dict:
    """What a record says of itself; a response's payload is hashed, not taken on trust."""
    end = record.index(b"\r\n\r\n")
    fields = parse_head(record[:end])
    block = record[end + 4 : end + 4 + int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["warc-type"]
    stated = fields["warc-payload-digest"].removeprefix("sha256:")
    if kind == "response":
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
        if digest != stated:
            raise ValueError(f"payload digest of {fields['warc-record-id']} doesn't match")
    else:
        size, digest = int(parse_head(http)["content-length"]), stated
    number = lambda k: int(fields[k]) if fields.get(k) else None
    return {"record_type": kind, "page_id": number("x-page-id"), "payload_bytes": size, "payload_digest": digest, "refers_to": number("x-refers-to-page-id")}


def read_member(fs: pafs.FileSystem, path: str, offset: int, length: int) -> bytes:
    """One record by its place in the index."""
    with fs.open_input_file(path) as f:
        return zlib.decompress(f.read_at(length, offset), 31)


def revisits(pages: DataFrame, least: int = 100) -> DataFrame:
    """(page_id, payload_digest, refers_to) of the pages that repeat an earlier payload of at least ``least`` bytes."""
    payload = F.encode(text_of("html"), "UTF-8")
    known = written(
        pages.where(F.octet_length(payload) >= least).select("page_id", F.unhex(F.sha2(payload, 256)).alias("payload_digest")), "payload-digests"
    )
    first = known.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    return known.join(first, "payload_digest").where("page_id > refers_to").distinct()


def write_archives(pages: DataFrame, folder: str, least: int = 100) -> DataFrame:
    """Write ``pages`` as archives below ``folder``, a partition each; the index as a DataFrame.

    Each task writes its pages as one gzip stream, hands that to the normaliser and
    removes it when the normalised archive is in place.
    """
    spark = pages.sparkSession
    again = written(revisits(pages, least), "revisits")
    few = again.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    own = pages.select("page_id", "url", text_of("html").alias("html")).withColumn(
        "payload_digest", F.when(F.octet_length("html") >= least, F.unhex(F.sha2(F.encode("html", "UTF-8"), 256)))
    )
    marked = own.join(F.broadcast(again) if few else again, ["page_id", "payload_digest"], "left").select("page_id", "url", "html", "refers_to")
    # In one order, whatever the join's: a task that runs again writes the same bytes, to which the index of another attempt fits.
    marked = marked.sortWithinPartitions("page_id", F.xxhash64("url", "html"), "refers_to")
    fs, top = _filesystem(folder)
    fs.create_dir(top, recursive=True)

    def write(batches):
        from pyspark import TaskContext

        context = TaskContext.get()
        fs, top = _filesystem(folder)
        name = f"pages-{context.partitionId():06d}"
        raw = f"{top}/{name}.{context.taskAttemptId()}.mono.gz"
        records = (
            record_bytes(p, u, h.encode("utf-8"), r)
            for b in batches
            for p, u, h, r in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True)
        )
        if write_monolith(fs, raw, records):
            work = f"{top}/{name}.{context.taskAttemptId()}"
            entries = normalise(fs, raw, work)
            for end in (".idx", ""):
                fs.move(work + end, f"{top}/{name}.warc.gz{end}")
            columns = {k: [x[k] for x in entries] for k in ("offset", "length", "record_type", "page_id", "payload_bytes", "payload_digest", "refers_to")}
            yield pa.RecordBatch.from_pydict({"archive": [f"{name}.warc.gz"] * len(entries)} | columns, schema=_INDEX)
        fs.delete_file(raw)

    return written(marked.mapInArrow(write, INDEX_SCHEMA), "warc-index")


_INDEX = pa.schema(
    [(n, pa.string() if t == "string" else pa.int64()) for n, t in (x.split() for x in INDEX_SCHEMA.split(", "))]
)


def read_archives(index: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """Read every record that ``index`` lists from the archives below ``folder``, each by its own offset.

    Adds ``payload`` (null for revisits) when ``payloads``.
    """

    def read(batches):
        fs, top = _filesystem(folder)
        name, handle = None, None
        for b in batches:
            rows = []
            for archive, offset, length in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if archive != name:
                    name, handle = archive, fs.open_input_file(f"{top}/{archive}")
                record = zlib.decompress(handle.read_at(length, offset), 31)
                row = {"archive": archive, "offset": offset, "length": length} | describe(record)
                if payloads:
                    row["payload"] = record.split(b"\r\n\r\n", 2)[2][:-4] if row["record_type"] == "response" else None
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema=_INDEX.append(pa.field("payload", pa.binary())) if payloads else _INDEX)

    return index.select("archive", "offset", "length").mapInArrow(read, INDEX_SCHEMA + (", payload binary" if payloads else ""))


def round_trip(pages: DataFrame, least: int = 100) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read every record back."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, least), folder)
