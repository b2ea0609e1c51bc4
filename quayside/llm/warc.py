"""WARC archives: one gzip member per record, written by tasks and read back one record after the other."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.batches import column
from quayside.llm.files import opened, written
from quayside.plans.session import Scratch, hinted

# Payloads shorter than this are stored again rather than referred to.
MIN_REVISIT = 1000
# An archive is closed once it has this many bytes.
ARCHIVE_BYTES = 256_000_000
CHUNK = 1 << 16
# A header line ends within so many bytes, more than any url of a page makes (three a byte of at most 2 GB would not fit a row).
LONGEST_LINE = 1 << 30
# Fixed values of the WARC 1.1 format.
_VERSION = b"WARC/1.1\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SCHEMA = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, error string"


def _name(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _page(name: str) -> int | None:
    number = name.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, level: int = 6) -> bytes:
    """One record as a gzip member. A revisit has the HTTP head of its page, whose length field tells the payload's size, and no payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _name(page_id)), ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else "about:blank"), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"),
        *([("WARC-Profile", _PROFILE), ("WARC-Refers-To", _name(refers_to))] if revisit else []),
        ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block))),
    ]
    text = _VERSION + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(text) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def write(pages: DataFrame, folder: str, scratch: Scratch, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write a record per row into archives under ``folder``; ``(path, records)`` of each archive.

    The payload is the html in UTF-8, null as empty. Of rows with equal payloads (by SHA-1 and length) of at least ``min_revisit`` bytes, that
    with the largest id is the response and the others revisit it; rows that repeat its id are responses too. A row
    without an id revisits, unless no equal row has one. Pages are not shuffled unless the equal payloads are many.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload")})
    equal = rows.where(F.col("size") >= min_revisit).groupBy("digest", "size").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    equal = scratch.keep(equal.select("digest", "size", "refers_to"), "equal")
    joined = rows.join(hinted(equal, equal.count()), ["digest", "size"], "left")
    again = F.col("refers_to").isNotNull() & ~F.col("refers_to").eqNullSafe(F.col("page_id"))
    planned = joined.select("page_id", "url", "payload", "digest", "refers_to", again.alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, archives = TaskContext.get().partitionId(), []
        rest = _rows(batches)
        first = next(rest, None)
        while first is not None:
            path = f"{folder}/part-{part:06d}-{len(archives):04d}.warc.gz"
            size = n = 0
            with written(path) as out:
                while first is not None and (not n or size < ARCHIVE_BYTES):
                    member = record(*first)
                    out.write(member)
                    size, n = size + len(member), n + 1
                    first = next(rest, None)
            archives.append((path, n))
        if archives:
            yield pa.RecordBatch.from_arrays([pa.array([a[0] for a in archives]), pa.array([a[1] for a in archives])], names=["path", "records"])

    return scratch.keep(planned.mapInArrow(run, "path string, records long"), "archives")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        names = ("page_id", "url", "payload", "digest", "refers_to", "revisit")
        cells = [column(batch, c) for c in names]
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in cells)


class _Member:
    """The bytes of one gzip member, unpacked as they are asked for."""

    def __init__(self, stream, before: bytes) -> None:
        self.stream, self.pending, self.ready = stream, before, b""
        self.unpacker = zlib.decompressobj(31)

    def more(self) -> bool:
        if self.unpacker.eof:
            return False
        chunk = self.pending or self.stream.read(CHUNK)
        self.pending = b""
        if not chunk:
            raise ValueError("the archive ends inside a record")
        self.ready += self.unpacker.decompress(chunk, CHUNK)
        while not self.unpacker.eof and self.unpacker.unconsumed_tail and len(self.ready) < CHUNK:
            self.ready += self.unpacker.decompress(self.unpacker.unconsumed_tail, CHUNK)
        self.pending = self.unpacker.unconsumed_tail
        return True

    def line(self) -> bytes:
        parts, size = [], 0
        while (at := self.ready.find(b"\r\n")) < 0:
            # all but the last byte, which may be half of the line's end
            parts.append(self.ready[:-1])
            size += len(parts[-1])
            self.ready = self.ready[-1:]
            if size > LONGEST_LINE or not self.more():
                raise ValueError("a header line has no end")
        parts.append(self.ready[:at])
        self.ready = self.ready[at + 2 :]
        return b"".join(parts)

    def block(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.ready and not self.more():
                raise ValueError("the record is shorter than its length field")
            part, self.ready = self.ready[:size], self.ready[size:]
            size -= len(part)
            if part:
                yield part

    def finish(self) -> bytes:
        """Check the record's end; what follows this member in the archive."""
        tail = self.ready
        while self.more():
            tail, self.ready = self.ready, b""
            if len(tail) > 4:
                break
        if (tail + (self.ready if self.ready is not tail else b""))[:4] != b"\r\n\r\n" and tail != b"\r\n\r\n":
            raise ValueError("the record is longer than its length field")
        return self.unpacker.unused_data


def records(stream) -> Iterator[dict]:
    """The records of an archive in order, in memory bounded by a chunk: framed by their length, digests verified.

    A record with a wrong digest comes with ``error`` set. An archive that is cut off or not in the format raises
    ``ValueError`` after the records before that place.
    """
    before = b""
    while before := before or stream.read(CHUNK):
        member = _Member(stream, before)
        if member.line() + b"\r\n" != _VERSION:
            raise ValueError("not a WARC 1.1 record")
        fields: dict[str, str] = {}
        while line := member.line():
            name, _, value = line.decode().partition(":")
            fields[name.lower()] = value.strip()
        whole, payload = hashlib.sha1(), hashlib.sha1()
        head, size = b"", 0
        inside = False
        for part in member.block(int(fields["content-length"])):
            whole.update(part)
            if not inside:
                head += part
                if b"\r\n\r\n" not in head:
                    continue
                head, _, part = head.partition(b"\r\n\r\n")
                inside = True
            payload.update(part)
            size += len(part)
        told = fields.get("warc-payload-digest", "").removeprefix("sha1:")
        wrong = [] if fields.get("warc-block-digest", "") == f"sha1:{whole.hexdigest()}" else ["block digest"]
        revisit = fields["warc-type"] == "revisit"
        if revisit:
            lengths = [v for k, _, v in (x.partition(":") for x in head.decode("latin-1").split("\r\n")) if k.lower() == "content-length"]
            size = int(lengths[0])
        elif told != payload.hexdigest():
            wrong.append("payload digest")
        yield {
            "page_id": _page(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "record_type": fields["warc-type"],
            "refers_to": _page(fields["warc-refers-to"]) if revisit else None, "payload_bytes": size,
            "payload_digest": told if revisit else payload.hexdigest(), "error": ", ".join(wrong) or None,
        }
        before = member.finish()


def read(archives: DataFrame, path_col: str = "path") -> DataFrame:
    """``(page_id, url, record_type, refers_to, payload_bytes, payload_digest, error)`` of every record of the archives named.

    One task takes an archive after the other, each from its first byte to its last. An archive that cannot be read to
    its end gives a last row with only ``error``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        names = [c.split()[0] for c in _SCHEMA.split(", ")]

        def packed(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], k) for n, k in zip(names, kinds, strict=True)], names=names)

        rows: list[dict] = []
        for batch in batches:
            for path in column(batch, path_col).to_pylist():
                fs, inner = opened(path)
                with fs.open_input_stream(inner, compression=None) as stream:
                    try:
                        for found in records(stream):
                            rows.append(found)
                            if len(rows) == 10_000:
                                yield packed(rows)
                                rows = []
                    except (ValueError, KeyError, zlib.error) as wrong:
                        rows.append({"error": f"{path}: {wrong}"})
        if rows:
            yield packed(rows)

    n = max(archives.count(), 1)
    return archives.select(path_col).repartition(min(n, 10_000), path_col).mapInArrow(run, _SCHEMA)
