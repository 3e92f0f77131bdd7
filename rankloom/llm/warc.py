"""Web archives: one gzip member per record, equal payloads stored once, a sequential reader.

Writing. ``write_warc`` turns pages into WARC/1.1 records in files of bounded size in a shared folder
and returns the table of files. Among payloads of ``min_bytes`` or more that are equal (SHA-256) the
row with the largest id becomes the ``response``; every other row is a ``revisit`` that names it and
holds no body. Copies are counted by partial aggregates of hashes, so a payload that a third of all
pages share costs one row per task; bodies move only where the table of copied payloads is too large
to broadcast, and then in a join whose hot keys adaptive execution splits. A file is named by
the attempt that writes it and counts only once its row is in the stored table of files, so lost or repeated
tasks leave nothing that a reader would see.

Reading. ``read_warc`` reads a file as a stream of 64 KB pieces: zlib inflates one member at a time
(its CRC is verified), a record's headers end at the empty line, ``Content-Length`` frames its block, and the
SHA-1 of block and payload are compared with the headers. Without ``payloads`` no body is ever held
whole. Damage is an error, or with ``strict=False`` a row with ``problem`` set, reading on at the next member.

Defined results: a null payload is empty; a null url leaves the header out; a null id is smaller than
any other and is written as an empty one. Rows that repeat id and payload stay all: one is the
response (of the smallest url), the others revisit it. Below ``min_bytes`` every row is a
response. An empty table gives no files and no records. Columns other than the three named are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from rankloom.llm.shared_files import open_folder, qualified
from rankloom.llm.tables import bounded_batches, join_by, stored
from rankloom.session import scratch_path

# --- fixed values (WARC 1.1) ------------------------------------------------
VERSION = "WARC/1.1"
IDENTICAL_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# ----------------------------------------------------------------------------

PIECE = 1 << 16
FILE_BYTES = 64 << 20
HEADER_LIMIT = 1 << 20
DATE = "1970-01-01T00:00:00Z"
_MANIFEST = "path string, n_records long, n_bytes long"
_RECORDS = (
    "path string, offset long, record_type string, record_id string, refers_to string, target_uri string, "
    "payload_bytes long, payload_digest string, payload binary, problem string"
)


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode("ascii")


# --- records --------------------------------------------------------------------------------------


def record(kind: str, record_id: str, block: bytes, **headers: str | None) -> bytes:
    """One record as a gzip member of its own; header names are given with ``_`` for ``-``."""
    lines = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}"]
    lines += [f"{name.replace('_', '-')}: {value}" for name, value in headers.items() if value is not None]
    lines += [f"WARC-Block-Digest: sha1:{base32_sha1(hashlib.sha1(block).digest())}", f"Content-Length: {len(block)}"]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return b"".join([pack.compress("\r\n".join(lines).encode("utf-8") + b"\r\n\r\n"), pack.compress(block), pack.compress(b"\r\n\r\n"), pack.flush()])


def _http_head(length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode("ascii")


class _Archive:
    """A file being written: a warcinfo record, then the records of pages."""

    def __init__(self, folder: str):
        store, base = open_folder(folder)
        name = f"pages-{uuid.uuid4().hex}.warc.gz"
        self.path = f"{folder.rstrip('/')}/{name}"
        self.out = store.open_output_stream(f"{base.rstrip('/')}/{name}", compression=None)
        self.records = self.bytes = 0
        info = b"software: rankloom\r\nformat: WARC File Format 1.1\r\n"
        self.add(record("warcinfo", f"urn:uuid:{uuid.uuid4()}", info, Content_Type="application/warc-fields"))

    def add(self, packed: bytes) -> None:
        self.out.write(packed)
        self.records += 1
        self.bytes += len(packed)

    def close(self) -> pa.RecordBatch:
        self.out.close()
        return pa.RecordBatch.from_arrays([pa.array([self.path]), pa.array([self.records], pa.int64()), pa.array([self.bytes], pa.int64())], ["path", "n_records", "n_bytes"])


def _page_record(page: str | None, url: str | None, body: bytes | None, sha1: str, length: int, top: str | None, revisit: bool, serial: str | None) -> bytes:
    digest = base32_sha1(bytes.fromhex(sha1))
    head = _http_head(length)
    own = f"urn:page:{quote(page or '', safe='')}:{digest}"
    common = {
        "WARC_Target_URI": None if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~-._"),
        "WARC_Payload_Digest": f"sha1:{digest}",
        "Content_Type": "application/http; msgtype=response",
    }
    if not revisit:
        return record("response", own if serial is None else f"{own}:{serial}", head + body, **common)
    target = f"<urn:page:{quote(top or '', safe='')}:{digest}>"
    return record("revisit", f"{own}:{serial}", head, **common, WARC_Profile=IDENTICAL_PAYLOAD, WARC_Refers_To=target)


def _writer(folder: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, task, serial = None, TaskContext.get().partitionId(), 0
        for batch in batches:
            columns = [batch.column(c) for c in ("page", "url", "body", "sha1", "length", "top", "revisit", "alone")]
            for i in range(batch.num_rows):
                page, url, body, sha1, length, top, revisit, alone = (c[i].as_py() for c in columns)
                if archive is None:
                    archive = _Archive(folder)
                serial += 1
                archive.add(_page_record(page, url, body, sha1, length, top, revisit, None if alone else f"{task}.{serial}"))
                if archive.bytes >= file_bytes:
                    yield archive.close()
                    archive = None
        if archive is not None:
            yield archive.close()

    return run


def _copies(rows: DataFrame, min_bytes: int) -> DataFrame:
    """``_key, _top, _ties`` of payloads that several rows carry: the largest id and how many rows have it."""
    counted = rows.where(F.octet_length("_body") >= min_bytes).groupBy("_key", "_id").agg(F.count(F.lit(1)).alias("n"))
    tops = counted.groupBy("_key").agg(F.sum("n").alias("_n"), F.max(F.struct("_id", "n")).alias("t"))
    return tops.where("_n > 1").select("_key", F.col("t._id").alias("_top"), F.col("t.n").alias("_ties"))


def _records(rows: DataFrame, copies: DataFrame, min_bytes: int) -> DataFrame:
    """The columns a record is written from, one row per page."""

    def shaped(df: DataFrame, revisit: Column, alone: Column) -> DataFrame:
        return df.select(
            F.col("_id").cast("string").alias("page"),
            F.col("_url").alias("url"),
            F.when(~revisit, F.col("_body")).alias("body"),
            F.sha1("_body").alias("sha1"),
            F.octet_length("_body").cast("long").alias("length"),
            F.col("_top").cast("string").alias("top"),
            revisit.alias("revisit"),
            alone.alias("alone"),
        )

    known = join_by(rows, copies, ["_key"], "left")
    copied = F.col("_ties").isNotNull() & (F.octet_length("_body") >= min_bytes)
    at_top = F.col("_id").eqNullSafe(F.col("_top"))
    tied = copied & at_top & (F.col("_ties") > 1)
    # a payload of min_bytes or more has one response, so its name needs no number
    plain = shaped(known.where(~F.coalesce(tied, F.lit(False))), F.coalesce(copied & ~at_top, F.lit(False)), (F.octet_length("_body") >= min_bytes) & (~copied | at_top))
    if copies.where("_ties > 1").limit(1).count() == 0:
        return plain
    # rows that repeat id and payload: partial aggregates keep one body and count the rest by url
    same = known.where(tied)
    first = same.groupBy("_key").agg(F.first("_id").alias("_id"), F.min(F.struct("_url"))["_url"].alias("_url"), F.first("_body").alias("_body"), F.first("_top").alias("_top"))
    counted = same.groupBy("_key", "_id", "_url").agg(F.count(F.lit(1)).alias("_n"), F.first("_body").alias("_body"), F.first("_top").alias("_top"))
    lead = first.select("_key", F.col("_url").alias("_lead"))
    rest = join_by(counted, lead, ["_key"], "left").withColumn("_n", F.col("_n") - F.col("_url").eqNullSafe(F.col("_lead")).cast("long"))
    others = rest.where("_n > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
    return plain.unionByName(shaped(first, F.lit(False), F.lit(True))).unionByName(shaped(others, F.lit(True), F.lit(False)))


def write_warc(
    pages: DataFrame, folder: str | None = None, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Archive every row of ``pages``; the stored table ``path, n_records, n_bytes`` of the files written.

    ``folder`` defaults to a new one below the session's shared folder. Payloads below ``min_bytes`` are
    never revisited. A task starts a new file beyond ``file_bytes``.
    """
    spark = pages.sparkSession
    target = qualified(spark, folder or scratch_path(spark, "warc"))
    store, base = open_folder(target)
    store.create_dir(base, recursive=True)
    payload = F.col(f"`{payload_col}`")
    if pages.schema[payload_col].dataType.typeName() != "binary":
        payload = payload.cast("string").cast("binary")
    body = F.coalesce(payload, F.lit("").cast("binary"))
    rows = bounded_batches(pages).select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{url_col}`").cast("string").alias("_url"), body.alias("_body"), F.sha2(body, 256).alias("_key"))
    copies = stored(_copies(rows, min_bytes), "copied_payloads")
    return stored(_records(rows, copies, min_bytes).mapInArrow(_writer(target, file_bytes), _MANIFEST), "warc_files")


# --- reader ---------------------------------------------------------------------------------------


class Damaged(ValueError):
    """A record or file that breaks the format."""


class Members:
    """Gzip members of a stream, inflated piece by piece."""

    def __init__(self, source) -> None:
        self.source, self.pending, self.taken = source, b"", 0
        self.inflate = None

    def _more(self) -> bytes:
        data = self.source.read(PIECE)
        self.taken += len(data)
        return data

    @property
    def offset(self) -> int:
        """Position in the file behind the last member."""
        return self.taken - len(self.pending)

    def next_member(self) -> bool:
        self.pending = self.pending or self._more()
        self.inflate = zlib.decompressobj(31) if self.pending else None
        return self.inflate is not None

    def read(self) -> bytes:
        """Up to ``PIECE`` inflated bytes of the member; empty at its end."""
        while not self.inflate.eof:
            data = self.inflate.unconsumed_tail
            if not data:
                data, self.pending = self.pending or self._more(), b""
            if not data:
                raise Damaged("the file ends inside a record")
            try:
                out = self.inflate.decompress(data, PIECE)
            except zlib.error as fault:
                raise Damaged(f"not a whole gzip member: {fault}") from fault
            if self.inflate.eof:
                self.pending = self.inflate.unused_data
            if out:
                return out
        return b""

    def skip(self) -> None:
        """To the end of the member."""
        while self.read():
            pass


@dataclass
class Record:
    offset: int
    headers: dict[str, str]
    payload_bytes: int = 0
    payload_digest: str = ""
    payload: bytes | None = None
    problem: str | None = None

    @property
    def kind(self) -> str | None:
        return self.headers.get("warc-type")

    def uri(self, name: str) -> str | None:
        value = self.headers.get(name)
        return None if value is None else value.strip("<>")


@dataclass
class _Block:
    """Digests of a block as its pieces pass, split into an HTTP head and the payload behind it."""

    http: bool
    keep: bool
    block: "hashlib._Hash" = field(default_factory=hashlib.sha1)
    body: "hashlib._Hash" = field(default_factory=hashlib.sha1)
    head: bytearray = field(default_factory=bytearray)
    size: int = 0
    parts: list[bytes] = field(default_factory=list)

    def add(self, piece: bytes) -> None:
        self.block.update(piece)
        if self.http:
            seen = max(0, len(self.head) - 3)
            self.head += piece
            end = self.head.find(b"\r\n\r\n", seen)
            if end < 0:
                if len(self.head) > HEADER_LIMIT:
                    raise Damaged("the HTTP head has no end")
                return
            self.http = False
            piece = bytes(self.head[end + 4 :])
            del self.head[end + 4 :]
        self.body.update(piece)
        self.size += len(piece)
        if self.keep:
            self.parts.append(piece)


def _headers(raw: bytes, first: str) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith(first):
        raise Damaged(f"a head begins with {lines[0][:40]!r}")
    out: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if line and not colon:
            raise Damaged(f"a header line without a colon: {line[:40]!r}")
        if line:
            out[name.strip().lower()] = value.strip()
    return out


def _length(headers: dict[str, str]) -> int:
    text = headers.get("content-length", "")
    if not (text.isascii() and text.isdigit()):
        raise Damaged(f"content length {text[:40]!r}")
    return int(text)


def _check(headers: dict[str, str], name: str, digest: str) -> None:
    given = headers.get(name)
    if given is not None and given.startswith("sha1:") and given[5:].upper() != digest:
        raise Damaged(f"{name} is {given[5:]}, the bytes have {digest}")


def read_record(members: Members, payloads: bool) -> Record:
    """The record of the member just opened; a ``Damaged`` one comes back with ``problem`` set."""
    found = Record(members.offset, {})
    try:
        held = bytearray()
        while (end := held.find(b"\r\n\r\n")) < 0:
            piece = members.read()
            if not piece or len(held) > HEADER_LIMIT:
                raise Damaged("the record head has no end")
            held += piece
        found.headers = _headers(bytes(held[:end]), "WARC/")
        left = _length(found.headers)
        http = found.headers.get("content-type", "").startswith("application/http")
        revisit = found.kind == "revisit"
        block = _Block(http, payloads and not revisit)
        piece = bytes(held[end + 4 :])
        while left > 0:
            piece = piece or members.read()
            if not piece:
                raise Damaged("the block is shorter than its content length")
            block.add(piece[:left])
            piece, left = piece[left:], max(0, left - len(piece))
        while len(piece) < 5 and (more := members.read()):
            piece += more
        if piece != b"\r\n\r\n":
            raise Damaged("the block is not followed by two line ends and the end of its member")
        if block.http:
            raise Damaged("the HTTP head has no end")
        _check(found.headers, "warc-block-digest", base32_sha1(block.block.digest()))
        if revisit:
            # the payload itself is elsewhere: its size and digest are what the headers say
            found.payload_bytes = _length(_headers(bytes(block.head), "HTTP/"))
            found.payload_digest = found.headers.get("warc-payload-digest", "").removeprefix("sha1:")
            if not found.headers.get("warc-refers-to"):
                raise Damaged("a revisit that refers to no record")
        else:
            found.payload_bytes, found.payload_digest = block.size, base32_sha1(block.body.digest())
            _check(found.headers, "warc-payload-digest", found.payload_digest)
            if block.head and "content-length" in (answered := _headers(bytes(block.head), "HTTP/")) and _length(answered) != block.size:
                raise Damaged("the payload has another length than its HTTP head says")
            found.payload = b"".join(block.parts) if payloads else None
    except Damaged as fault:
        found.problem = str(fault)
    return found


def records(source, *, payloads: bool = False) -> Iterator[Record]:
    """All records of an open file, in order. Behind damage reading goes on at the next member, where that is found."""
    members = Members(source)
    while members.next_member():
        found = read_record(members, payloads)
        yield found
        if found.problem is not None:
            try:
                members.skip()
            except Damaged:
                return


def read_warc(files: DataFrame, *, payloads: bool = False, strict: bool = True) -> DataFrame:
    """Every record of ``files`` (``path``): a file is one task's stream.

    ``path, offset, record_type, record_id, refers_to, target_uri, payload_bytes, payload_digest, payload,
    problem``; ``payload`` is null without ``payloads`` and in revisits, whose size and digest are those of the payload
    they stand for. ``strict`` raises on damage, else ``problem`` says what it is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, name = open_folder(path)
                rows, held = [], 0
                with store.open_input_stream(name, compression=None, buffer_size=PIECE) as source:
                    for r in records(source, payloads=payloads):
                        if strict and r.problem:
                            raise Damaged(f"{path} at {r.offset}: {r.problem}")
                        rows.append((path, r.offset, r.kind, r.uri("warc-record-id"), r.uri("warc-refers-to"), r.headers.get("warc-target-uri"), r.payload_bytes, r.payload_digest, r.payload, r.problem))
                        held += 200 + len(r.payload or b"")
                        if held > 4 << 20:
                            yield _batch(rows)
                            rows, held = [], 0
                yield _batch(rows)

    n = max(1, min(files.count(), 100_000))
    return files.select("path").repartition(n, F.xxhash64("path")).mapInArrow(run, _RECORDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string()]
    names = [c.split()[0] for c in _RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def page_of(uri: Column) -> Column:
    """The page id in a record id that ``write_warc`` gave; null where it was null."""
    text = F.regexp_extract(uri, "^urn:page:([^:]*):", 1)
    return F.when(text != "", F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))))
