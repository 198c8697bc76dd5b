"""WARC archives: a writer with revisit records and a splittable reader.

Writing: each record is a gzip member of its own. Of pages with equal payloads of at least
``REVISIT_BYTES`` bytes, the one with the smallest id is a response, the others are revisits
that carry no payload. Spark's text writer puts the members into files, with an empty gzip
member as the separator, so that a file is nothing but gzip members.

Reading: Spark cuts the files into byte ranges. A task scans its ranges for the gzip magic (as
the text reader's line separator) and owns the members that start inside; a member that goes on
beyond the range is read to its end. A place is a member only if its gzip header decodes and
its content begins a WARC record (or is empty); compressed bytes that merely look like the
magic are given back to the member they lie in. If such a place is the first in another task's
range, both tasks hand out the torn pieces, and these few are joined by file afterwards.
Archives are read under names that do not end in ``.gz``, as Hadoop would unpack those itself.

Defined results: null html is an empty payload; null urls are left out of the record; a row
without id gets a record without page number, and is never the one that others refer to. Rows
that repeat a page id and payload are written as often as they occur, as responses if theirs is
the smallest id. Bytes between members and damaged members are skipped.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loopcount.llm.common import shared_folder, prepare, sliced, small_enough, stored

REVISIT_BYTES = 100
LEVEL = 4
DATE = "2024-01-01T00:00:00Z"
#: Fixed values of the formats.
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PAGE = "urn:x-page:"


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record, uncompressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <{_PAGE}{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url:
        lines.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~-._|{}^`\"<>\\"))
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{_PAGE}{refers_to}>"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, path: str) -> None:
    """Write ``pages`` (page_id, url, html) as archives under ``path``."""
    prepare(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
                        F.col("url").cast("string").alias("url")).withColumn("digest", F.unhex(F.sha2("html", 256)))
    many = F.octet_length("html") >= REVISIT_BYTES
    firsts = stored(rows.filter(many).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
                    .filter((F.col("n") > 1) & F.col("first").isNotNull()).select("digest", "first"), "warc-firsts")
    side = F.broadcast(firsts) if small_enough(firsts, 64) else firsts

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text_column=1):
            members = []
            for page_id, html, url, digest, first in zip(*(batch.column(i).to_pylist() for i in range(5))):
                refers = first if first is not None and first != page_id else None
                members.append(gzip_member(record(page_id, url, html.encode("utf-8"), digest.hex(), refers)))
            yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], names=["member"])

    joined = rows.join(side, "digest", "left").select("page_id", "html", "url", "digest", "first")
    (joined.mapInArrow(run, "member binary").select(F.col("member").cast("string").alias("value"))
     .write.option("lineSep", gzip_member(b"").decode("latin-1")).option("encoding", "ISO-8859-1").text(path))


class Members:
    """Gzip members of one byte range from its chunks, which begin at each place of the magic."""

    def __init__(self):
        self.found = False  # a WARC record has begun in this range
        self._open = None  # decompressor, chunks and content of a member that goes on

    def feed(self, chunk: bytes) -> tuple[list[bytes], list[bytes]]:
        """(contents of members that end by this chunk, chunks that belong to no member here)."""
        if self._open is not None and self._sure():
            try:
                return self._go_on(chunk), []
            except zlib.error:
                return self._again([chunk])
        packer = zlib.decompressobj(31)
        try:
            content = packer.decompress(chunk)
        except zlib.error:
            content = None
        likely = content is not None and content.startswith(b"WARC/")
        if self._open is not None and not likely:  # one that has shown no content yet goes first
            try:
                return self._go_on(chunk), []
            except zlib.error:
                pass
        lost = self.rest() if not self.found else []
        self._open = None
        if content is not None and b"WARC/".startswith(content[:5]):
            self.found |= likely
            if packer.eof and content:
                return [content], lost
            if not packer.eof:
                self._open = (packer, [chunk], [content])
                return [], lost
        return [], lost + ([] if self.found else [chunk])

    def _again(self, more: list[bytes]) -> tuple[list[bytes], list[bytes]]:
        """A damaged member: the chunks after its first may hold members themselves."""
        chunks, contents, lost = self._open[1][1:] + more, [], []
        self._open = None
        for chunk in chunks:
            got, away = self.feed(chunk)
            contents += got
            lost += away
        return contents, lost

    def finish(self) -> list[bytes]:
        """Contents of the members behind one that never ended."""
        contents: list[bytes] = []
        while self._open is not None:
            contents += self._again([])[0]
        return contents

    def _sure(self) -> bool:
        return any(self._open[2])

    def _go_on(self, chunk: bytes) -> list[bytes]:
        packer, raw, content = self._open
        new = packer.decompress(chunk)
        if not self._sure() and not b"WARC/".startswith(new[:5]):
            raise zlib.error("no record")
        raw.append(chunk)
        content.append(new)
        self.found |= self._sure()
        if not packer.eof:
            return []
        self._open = None
        return [b"".join(content)]

    def rest(self) -> list[bytes]:
        """The chunks of a member that goes on."""
        return self._open[1] if self._open is not None else []


def parse(content: bytes) -> dict | None:
    """Type, page, url, payload size, digest and payload of a record; None if it is none."""
    head, found, block = content.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"WARC/"):
        return None
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower()] = value.strip().decode("utf-8", "replace")
    block = block[:int(fields.get(b"content-length", len(block)))]
    http, _, payload = block.partition(b"\r\n\r\n")
    page = lambda name: int(v) if (v := fields.get(name, "").strip("<>").removeprefix(_PAGE)).lstrip("-").isdigit() else None
    kind = fields.get(b"warc-type", "")
    size, digest = len(payload), ""
    if kind == "revisit":
        for line in http.split(b"\r\n"):
            if line.lower().startswith(b"content-length:"):
                size = int(line.partition(b":")[2])
        digest, payload = fields.get(b"warc-payload-digest", "").removeprefix("sha256:"), None
    else:
        digest = hashlib.sha256(payload).hexdigest()
    return {"page_id": page(b"warc-record-id"), "url": fields.get(b"warc-target-uri"), "payload_bytes": size, "payload_digest": digest,
            "record_type": kind, "refers_to": page(b"warc-refers-to"), "payload": payload}


_RECORD = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
           ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
_RECORD_DDL = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
_PIECE = [("file", pa.string()), ("block", pa.int64()), ("place", pa.int64()), ("piece", pa.binary())]


def _batch(rows: list[dict], fields) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[name] for r in rows], kind) for name, kind in fields], schema=pa.schema(fields))


def _chunks(batches) -> Iterator[tuple[tuple[str, int], bytes | None, bool]]:
    """((file, block), chunk with its magic, whether it ends the block), in order."""
    last = None
    for batch in batches:
        for value, file, block in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if last is not None and last != (file, block):
                yield last, None, True
            begins = block == 0 and last != (file, block)
            last = (file, block)
            if not (begins and not value):
                yield last, value if begins else MAGIC + value, False
    if last is not None:
        yield last, None, True


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row a record: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload
    (null for revisits, and everywhere without ``payloads``)."""
    prepare(spark)
    fields = _RECORD

    def row(content: bytes) -> dict | None:
        got = parse(content)
        if got and not payloads:
            got["payload"] = None
        return got

    def whole(batches) -> Iterator[pa.RecordBatch]:
        members, out, size = Members(), [], 0
        for _, chunk, ends in _chunks(batches):
            if ends:
                members = Members()
                continue
            for got in filter(None, map(row, members.feed(chunk)[0])):
                out.append(got)
                size += len(got["payload"] or b"") + 200
            if size > 1 << 20:
                yield _batch(out, fields)
                out, size = [], 0
        yield _batch(out, fields)

    def torn(batches) -> Iterator[pa.RecordBatch]:
        members, place = Members(), 0
        for (file, block), chunk, ends in _chunks(batches):
            for piece in members.rest() if ends else members.feed(chunk)[1]:
                yield _batch([{"file": file, "block": block, "place": place, "piece": piece}], _PIECE)
                place += 1
            if ends:
                members, place = Members(), 0

    def joined(pieces: pa.Table) -> pa.Table:
        members, contents = Members(), []
        for piece in pieces.sort_by([("block", "ascending"), ("place", "ascending")])["piece"].to_pylist():
            contents += members.feed(piece)[0]
        return pa.Table.from_batches([_batch(list(filter(None, map(row, contents + members.finish()))), fields)])

    chunks = (spark.read.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
              .select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")))
    pieces = chunks.mapInArrow(torn, "file string, block long, place long, piece binary")
    return chunks.mapInArrow(whole, _RECORD_DDL).unionByName(pieces.groupBy("file").applyInArrow(joined, _RECORD_DDL))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back, without payloads."""
    path = shared_folder(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
