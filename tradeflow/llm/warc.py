"""WARC archives: writing, normalising whole-file gzip streams, reading back.

An archive compressed as one gzip stream must be inflated from its start to
reach any record. The normaliser inflates each such stream once, with bounded
memory, rewrites every record as a gzip member of its own, and writes a sidecar
index of offsets beside the new archive, so that any record can be read alone.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator
from contextlib import closing
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import join_counted, scratch, scratch_path
from tradeflow.llm.files import locate, own_name

#: Payloads shorter than this are never recorded as revisits.
LEAST_REVISIT = 100
#: Uncompressed bytes after which a new archive is begun.
ARCHIVE_BYTES = 64 << 20
READ_BYTES = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "archive string, offset long, length long, record_id string, record_type string"
RECORD = ("archive string, page_id long, url string, payload_bytes long, payload_digest string, "
          "record_type string, refers_to long, payload binary")


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (UTF-8 bytes of html; null is empty),
    payload_digest (SHA-256), record_type and refers_to of each page.

    Of pages with equal payloads of at least LEAST_REVISIT bytes the one with
    the smallest page_id is the response and the others revisit it; rows that
    repeat that page_id are responses too, and pages without an id rank last (a
    group with no id at all is responses only). Smaller payloads are all
    responses.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary")).alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha2("payload", 256))
    groups = scratch(rows.filter(F.octet_length("payload") >= LEAST_REVISIT).groupBy("payload_digest")
                     .agg(F.min("page_id").alias("response_id"), F.count("*").alias("n"))
                     .filter((F.col("n") > 1) & F.col("response_id").isNotNull()), "warc-groups")
    revisit = F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    return join_counted(rows, groups, ["payload_digest"], "n", pages.count(), "left").select(
        "page_id", "url", "payload", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("response_id")).alias("refers_to"))


def _header_text(value: str) -> str:
    """A header's value: line ends and other controls are percent-encoded."""
    return "".join(quote(c) if ord(c) < 32 or ord(c) == 127 else c for c in value)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str,
                 record_type: str, refers_to: int | None, row: str, date: str) -> bytes:
    """One WARC/1.1 record. A revisit has the HTTP header but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if record_type == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}:{row}>",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}",
            f"Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_text(url)}")
    if record_type == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_monolithic(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES,
                     date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write the rows of ``with_revisits`` as archives that are one gzip stream
    each; rows (archive, records). A task begins a new archive after
    ``archive_bytes``; a table without rows gives none."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, n, size, made = None, "", 0, 0, []
        try:
            for batch in batches:
                for row in zip(*(c for c in batch.columns)):
                    page_id, url, payload, digest, kind, refers_to = (x.as_py() for x in row)
                    if out is None:
                        name, n, size = own_name(folder, ".warc.gz"), 0, 0
                        fs, path = locate(name)
                        fs.create_dir(path.rpartition("/")[0], recursive=True)
                        out, gz = fs.open_output_stream(path, compression=None), zlib.compressobj(6, wbits=31)
                    record = record_bytes(page_id, url, payload, digest, kind, refers_to,
                                          f"{name.rpartition('-')[2][:32]}.{n}", date)
                    out.write(gz.compress(record))
                    n, size = n + 1, size + len(record)
                    if size >= archive_bytes:
                        out.write(gz.flush())
                        out.close()
                        out = None
                        made.append((name, n))
            if out is not None:
                out.write(gz.flush())
                made.append((name, n))
        finally:
            if out is not None:
                out.close()
        yield pa.RecordBatch.from_pydict({"archive": pa.array([a for a, _ in made], pa.string()),
                                          "records": pa.array([b for _, b in made], pa.int64())})

    return records.select("page_id", "url", "payload", "payload_digest", "record_type", "refers_to").mapInArrow(
        write, "archive string, records long")


def _inflated(chunks: Iterator[bytes], name: str) -> Iterator[bytes]:
    """The inflated bytes of one or more gzip members, in pieces."""
    gz, fed = zlib.decompressobj(31), False
    for chunk in chunks:
        while chunk:
            fed = True
            try:
                data = gz.decompress(chunk, 4 * READ_BYTES)
            except zlib.error as e:
                raise ValueError(f"{name}: damaged gzip stream: {e}") from e
            if data:
                yield data
            chunk = gz.unconsumed_tail
            if gz.eof:
                chunk, gz, fed = gz.unused_data, zlib.decompressobj(31), False
    if fed:
        raise ValueError(f"{name}: the gzip stream ends early")


class _Stream:
    """Reads lines and byte counts from pieces."""

    def __init__(self, pieces: Iterator[bytes], name: str):
        self.pieces, self.held, self.at, self.name = pieces, b"", 0, name

    def _more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is not None:
            self.held, self.at = self.held[self.at:] + piece, 0
        return piece is not None

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with the mark; None at the end of the stream."""
        while (end := self.held.find(mark, self.at)) < 0:
            if not self._more():
                if self.held[self.at:].strip():
                    raise ValueError(f"{self.name}: a record is cut off")
                return None
        out = self.held[self.at:end + len(mark)]
        self.at = end + len(mark)
        return out

    def take(self, n: int) -> bytes:
        parts, have = [], 0
        while have < n:
            if self.at == len(self.held) and not self._more():
                raise ValueError(f"{self.name}: a record is cut off")
            part = self.held[self.at:self.at + n - have]
            self.at += len(part)
            have += len(part)
            parts.append(part)
        return b"".join(parts)


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").strip("\r\n").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def _records(stream: _Stream) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """(header fields, header bytes, block bytes) of each record."""
    while (head := stream.until(b"\r\n\r\n")) is not None:
        head = head.lstrip(b"\r\n")
        if not head.startswith(b"WARC/"):
            raise ValueError(f"{stream.name}: no WARC record where one must begin")
        fields = _fields(head)
        block = stream.take(int(fields["content-length"]))
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError(f"{stream.name}: a record does not end where its length says")
        yield fields, head, block


def _chunks(name: str) -> Iterator[bytes]:
    fs, path = locate(name)
    with closing(fs.open_input_stream(path, compression=None)) as source:
        while chunk := source.read(READ_BYTES):
            yield chunk


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite each archive named in column ``archive`` with one gzip member per
    record; rows of the index (archive, offset, length, record_id, record_type).

    The same rows, one JSON object a line, are written beside each new archive
    as ``<archive>.idx``. An archive that is damaged or cut off fails the job
    and is named in the error. Archives that are already split into members
    are read alike. An archive without records gives an empty one.
    """
    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source in batch.column("archive").to_pylist():
                name = own_name(folder, ".warc.gz")
                fs, path = locate(name)
                fs.create_dir(path.rpartition("/")[0], recursive=True)
                rows: dict[str, list] = {k: [] for k in ("archive", "offset", "length", "record_id", "record_type")}
                offset = 0
                with closing(fs.open_output_stream(path, compression=None)) as out:
                    for fields, head, block in _records(_Stream(_inflated(_chunks(source), source), source)):
                        gz = zlib.compressobj(6, wbits=31)
                        member = gz.compress(head + block + b"\r\n\r\n") + gz.flush()
                        out.write(member)
                        for k, v in (("archive", name), ("offset", offset), ("length", len(member)),
                                     ("record_id", fields["warc-record-id"]), ("record_type", fields["warc-type"])):
                            rows[k].append(v)
                        offset += len(member)
                with closing(fs.open_output_stream(path + ".idx", compression=None)) as out:
                    for row in zip(*rows.values()):
                        out.write(json.dumps(dict(zip(rows, row))).encode() + b"\n")
                yield pa.RecordBatch.from_pydict(rows, pa.schema(
                    [("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                     ("record_id", pa.string()), ("record_type", pa.string())]))

    n = archives.count()
    return archives.select("archive").repartition(max(1, n)).mapInArrow(rewrite, INDEX)


def read_records(index: DataFrame) -> DataFrame:
    """The records that the rows of ``index`` point to, each read alone by its
    offset: archive, page_id, url, payload_bytes, payload_digest, record_type,
    refers_to and payload (null for revisits). A response whose payload does
    not have its digest fails the job."""
    def number(urn: str | None) -> int | None:
        found = (urn or "").strip("<>").split(":")[2:3]
        return int(found[0]) if found and found[0] else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORD.split(", ")]
        schema = pa.schema([(x.split()[0], {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[x.split()[1]])
                            for x in RECORD.split(", ")])
        now, source = None, None
        try:
            for batch in batches:
                rows, size = [], 0
                for name, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))):
                    if name != now:
                        if source is not None:
                            source.close()
                        fs, path = locate(name)
                        source, now = fs.open_input_file(path), name
                    source.seek(offset)
                    (fields, _, block), = _records(_Stream(_inflated(iter([source.read(length)]), name), name))
                    http, _, payload = block.partition(b"\r\n\r\n")
                    n_bytes = int(_fields(http)["content-length"])
                    digest = fields["warc-payload-digest"].partition(":")[2]
                    kind = fields["warc-type"]
                    if kind == "response" and (len(payload) != n_bytes or hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError(f"{name} at {offset}: the payload does not have its digest")
                    rows.append((name, number(fields["warc-record-id"]), fields.get("warc-target-uri"), n_bytes, digest,
                                 kind, number(fields.get("warc-refers-to")), payload if kind == "response" else None))
                    size += len(block)
                    if size >= 8 * READ_BYTES:
                        yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows))), schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows))), schema)
        finally:
            if source is not None:
                source.close()

    return index.select("archive", "offset", "length").mapInArrow(read, RECORD)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as whole-stream archives, normalise
    them and return the index of the normalised archives."""
    spark = pages.sparkSession
    whole = scratch(write_monolithic(with_revisits(pages), scratch_path(spark, "warc-whole")), "warc-manifest")
    return scratch(normalise(whole, scratch_path(spark, "warc")), "warc-index")
