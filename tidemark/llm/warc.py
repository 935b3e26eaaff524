"""A deterministic sharded WARC writer, and a reader.

Records are ordered by page id: the table is cut into id ranges, each range is one task's sorted
stream and fills a series of files, which roll at a compressed size.  Every record is a gzip member
of its own; headers and digests are made anew from the payload.  Of equal payloads the one with the
greatest page id is stored, the others are ``revisit`` records that name it.  Nothing in a file
depends on the clock, the attempt or the order of arrival: a rerun writes the same bytes.  Files are
committed through temporary names and a manifest (``shards``).
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import shards
from tidemark.llm.frames import block_of, buckets_for, key_edges

#: A file is closed when it has this many compressed bytes.
ROLL = 256 << 20
#: The records' date, a parameter, as the table has none.
DATE = "2020-01-01T00:00:00Z"
_LEVEL = 4
_UNSAFE = re.compile(r"[\x00-\x20\x7f<>]")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    name = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if name == "none" else int(name)


def _member(data: bytes) -> bytes:
    """A gzip member without a time stamp."""
    squeeze = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
           date: str = DATE) -> bytes:
    """One record; with ``refers_to`` a revisit, which keeps the HTTP headers but no payload."""
    uri = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url or "") or f"urn:page:{page_id}"
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
            + str(len(payload)).encode() + b"\r\n\r\n")
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {date}",
            f"WARC-Target-URI: {uri}", "Content-Type: application/http;msgtype=response",
            f"WARC-Payload-Digest: sha1:{digest(payload)}",
            f"WARC-Block-Digest: sha1:{digest(block)}"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _info(name: str, date: str) -> bytes:
    body = b"format: WARC File Format 1.1\r\n"
    head = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:file:{name}>",
            f"WARC-Date: {date}", f"WARC-Filename: {name}", "Content-Type: application/warc-fields",
            f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


_WRITTEN = "temporary string, name string, bytes long, records long, first long, last long"
_WRITTEN_ARROW = pa.schema([("temporary", pa.string()), ("name", pa.string()),
                            ("bytes", pa.int64()), ("records", pa.int64()), ("first", pa.int64()),
                            ("last", pa.int64())])


def _write(root: str, roll: int, date: str):
    """Files of one block's rows, which come by page id; a row of a mark alone comes first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, facts, block, number = None, {}, None, 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([shard.close() | facts], _WRITTEN_ARROW)

        marked, refers = None, {}  # by digest of the payload, as an id may have several
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                for row in batch.slice(a, 64).to_pylist():
                    page = row["page_id"]
                    if row["mark"]:
                        if page != marked:
                            marked, refers = page, {}
                        refers[row["sha"]] = row["refers_to"]
                        continue
                    if row["block"] != block:
                        if shard:
                            yield close()
                        shard, block, number = None, row["block"], 0
                    if shard is None:
                        name = f"pages-{block:07d}-{number:05d}.warc.gz"
                        shard = shards.Shard(root, name)
                        shard.write(_member(_info(name, date)))
                        facts = {"records": 0, "first": page, "last": page}
                    payload = (row["html"] or "").encode()
                    to = refers.get(hashlib.sha1(payload).hexdigest()) if page == marked else None
                    shard.write(_member(record(page, row["url"], payload, to, date)))
                    facts["records"] += 1
                    facts["last"] = page
                    if shard.size >= roll:
                        yield close()
                        shard, number = None, number + 1
        if shard:
            yield close()
    return run


def write(pages: DataFrame, root: str, least: int = 0, roll: int = ROLL,
          date: str = DATE) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) into the folder ``root``; returns the manifest.

    Of payloads of at least ``least`` bytes that are equal, the greatest page id is a response and
    lower ones revisit it; rows that share the greatest id are all responses, and a null id, which
    comes first in order, is always one.  Rows of one id are judged each by its payload.  A null html is the empty payload; a null url is replaced
    by the record's name.  Only page ids and digests are grouped: a mark for each revisit meets its
    page again in the page's id range, so the payloads move once.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.coalesce("html", F.lit("")).alias("html"))
    keys = rows.filter(F.col("page_id").isNotNull() & (F.octet_length("html") >= least)).select(
        "page_id", F.sha1(F.col("html").cast("binary")).alias("sha"))
    kept = (keys.groupBy("sha").agg(F.max("page_id").alias("refers_to"),
                                    F.min("page_id").alias("lowest"))
            .filter("refers_to <> lowest").select("sha", "refers_to"))
    marks = (keys.join(kept, "sha").filter("page_id < refers_to")
             .select("page_id", "sha", "refers_to").distinct())
    edges = key_edges(rows, "page_id", buckets_for(rows))
    both = (rows.withColumn("refers_to", F.lit(None).cast("long")).withColumn(
                "sha", F.lit(None).cast("string")).withColumn("mark", F.lit(False))
            .unionByName(marks.withColumn("mark", F.lit(True)), allowMissingColumns=True)
            .withColumn("block", block_of(F.col("page_id"), edges).cast("int"))
            .repartitionById(len(edges) + 1, F.col("block"))
            .sortWithinPartitions("block", "page_id", F.desc("mark"), "html", "url"))
    return shards.publish(both.mapInArrow(_write(root, roll, date), _WRITTEN), root)


def records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a gzip-compressed archive, read member by member."""
    member, data = zlib.decompressobj(31), []
    for chunk in chunks:
        while chunk:
            data.append(member.decompress(chunk))
            chunk = b""
            if member.eof:
                chunk = member.unused_data
                whole = b"".join(data)
                member, data = zlib.decompressobj(31), []
                head, _, rest = whole.partition(b"\r\n\r\n")
                lines = head.decode().split("\r\n")
                fields = dict(line.split(": ", 1) for line in lines[1:])
                size = int(fields["Content-Length"])
                if len(rest) != size + 4:
                    raise ValueError(f"record {fields.get('WARC-Record-ID')} is cut off")
                yield fields, rest[:size]
    if any(data):
        raise ValueError("an archive ends inside a record")


_READ = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
         "refers_to long, url string")


def read(manifest: DataFrame, root: str, with_payload: bool = False) -> DataFrame:
    """The records in the manifest's files; digests of stored payloads are computed and compared."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
                   ] + ["payload"] * with_payload
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(),
                 pa.binary()]
        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows, size = [], 0
                with shards.read_bytes(root, name) as f:
                    for fields, block in records(iter(lambda: f.read(1 << 20), b"")):
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        named = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        response = fields["WARC-Type"] == "response"
                        if response and digest(payload) != named:
                            raise ValueError(f"{fields['WARC-Record-ID']} is damaged")
                        length = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        refers = None if response else _page(fields["WARC-Refers-To"])
                        rows.append((_page(fields["WARC-Record-ID"]), length, named,
                                     fields["WARC-Type"], refers, fields["WARC-Target-URI"],
                                     payload)[:len(columns)])
                        size += len(payload) * with_payload
                        if len(rows) >= 1000 or size > 4 << 20:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(x, k) for x, k in zip(zip(*rows), kinds)], columns)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, k) for x, k in zip(zip(*rows), kinds)], columns)
    n = max(1, manifest.count())
    return manifest.select("name").repartition(n).mapInArrow(
        run, _READ + ", payload binary" * with_payload)
