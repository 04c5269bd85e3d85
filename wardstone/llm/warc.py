"""WARC archives: a writer, and a reader that salvages what follows damage.

Records are gzip members of their own, one after the other, as archives usually are; plain records are read as well. The
reader checks each record in turn: the member must inflate whole, its head must begin with a version line and carry a
length that the block has, and a stated payload digest must hold. A head may be of any length. After a failed check it
searches on from the next byte for a gzip member that inflates to a version line, or for a plain version line, takes
reading up again there, and logs the bytes between as a quarantined gap. Files are streamed in blocks: memory follows the
longest record, not the archive.

Files are written and read by the tasks themselves, in a folder that all executors share. A task writes under a name of
its own attempt and renames at the end, so a task that runs twice leaves one whole file.

Defined results: null payloads are empty; pages without an id keep a null id. Of equal payloads of at least `DEDUP_BYTES`
bytes that with the smallest page_id is the response and the others revisit it; rows that repeat this page_id are
responses too. Extra columns are ignored. An empty table gives no archive, an empty folder no records.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEDUP_BYTES = 100
READ_BYTES = 1 << 20
VERSION = re.compile(rb"WARC/\d\.\d\r\n")
MEMBER = b"\x1f\x8b\x08"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder named as Spark names it, and the path there."""
    if "://" not in uri:
        return fs.FileSystem.from_uri(uri.replace("file:", "file://", 1) if uri.startswith("file:") else "file://" + uri)
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


# Writing


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member. Revisits have no payload of their own but state its digest and length."""
    is_revisit = refers_to is not None
    block = b"" if is_revisit else HTTP % len(payload) + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {re.sub(r'[\x00-\x20]', lambda m: f'%{ord(m[0]):02X}', url or '')}", "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}", "Content-Type: application/http; msgtype=response",
    ]
    if is_revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    text = "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode()
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(text + block + b"\r\n\r\n") + packer.flush()


def _written(folder: str):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = file_system(folder)
        context = TaskContext.get()
        own = f"{path}/.attempt-{context.taskAttemptId()}-{uuid.uuid4().hex}"
        count, stream = 0, None
        for batch in batches:
            for page, url, html, digest, refers_to in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if stream is None:
                    stream = store.open_output_stream(own, compression=None)
                stream.write(record(page, url, (html or "").encode(), digest, refers_to))
                count += 1
        if stream is not None:
            stream.close()
            store.move(own, f"{path}/part-{context.partitionId():06d}.warc.gz")
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], names=["records"])

    return of


def write_archives(pages: DataFrame, folder: str) -> int:
    """Writes a record per row of pages (page_id, url, html) to archives in a new folder; the number of records."""
    store, path = file_system(folder)
    store.create_dir(path, recursive=True)
    payload = F.coalesce("html", F.lit(""))
    hashed = pages.select("page_id", "url", "html", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("size"))
    first = hashed.where(F.col("size") >= DEDUP_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    joined = hashed.join(first.select("digest", "first"), "digest", "left")
    refers_to = F.when(F.col("first") != F.col("page_id"), F.col("first"))
    rows = joined.select("page_id", "url", "html", "digest", refers_to.alias("refers_to"))
    return rows.mapInArrow(_written(folder), "records long").agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]


# Reading


@dataclass
class Found:
    """A record, or a gap, with its bytes in the file."""

    begin: int
    end: int
    kind: str
    headers: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""
    reason: str = ""


class Bad(Exception):
    """A check that failed."""


class Window:
    """A file read forwards, of which the bytes from `base` on are held."""

    def __init__(self, stream):
        self.stream, self.base, self.held, self.ended = stream, 0, bytearray(), False

    def reach(self, to: int) -> bool:
        """Holds the bytes up to `to`; whether there are so many."""
        while not self.ended and self.base + len(self.held) < to:
            more = self.stream.read(READ_BYTES)
            self.ended = not more
            self.held += more
        return self.base + len(self.held) >= to

    def forget(self, before: int) -> None:
        if before - self.base >= READ_BYTES:
            del self.held[: before - self.base]
            self.base = before

    def find(self, at: int, what: re.Pattern, margin: int) -> int | None:
        """The first match at or after `at`; margin: bytes a match may have."""
        while True:
            self.reach(at + READ_BYTES)
            match = what.search(self.held, at - self.base)
            if match:
                return self.base + match.start()
            if self.ended:
                return None
            at = max(at, self.base + len(self.held) - margin)
            self.forget(at)


def parsed(data: bytes) -> tuple[dict[str, str], int, int]:
    """Headers, and begin and end of the block of a record that begins here."""
    if not VERSION.match(data):
        raise Bad("no version line")
    stop = data.find(b"\r\n\r\n")
    if VERSION.search(data, 1, stop if stop >= 0 else len(data)):
        raise Bad("another record in the head")
    if stop < 0:
        raise Bad("no end of the head")
    headers = {}
    for line in bytes(data[:stop]).decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Bad("no header line")
        headers[name.strip().lower()] = value.strip()
    if not re.fullmatch(r"\d{1,15}", headers.get("content-length", "")):
        raise Bad("no length")
    return headers, stop + 4, stop + 4 + int(headers["content-length"])


def checked(headers: dict[str, str], block: bytes) -> bytes:
    """The payload of a block whose digest holds."""
    payload = block
    if headers.get("content-type", "").startswith("application/http"):
        payload = block.partition(b"\r\n\r\n")[2] if block else b""
    kind, _, digest = headers.get("warc-payload-digest", "").partition(":")
    if kind == "sha256" and headers.get("warc-type") != "revisit" and hashlib.sha256(payload).hexdigest() != digest:
        raise Bad("payload digest")
    return payload


def inflated(window: Window, at: int) -> tuple[bytes, int]:
    """What the gzip member at this byte holds, and where it ends. Gives up on the first block without a version line."""
    unpacker, out, to = zlib.decompressobj(31), bytearray(), at
    while not unpacker.eof:
        if not window.reach(to + 1):
            raise Bad("member cut off")
        piece = bytes(window.held[to - window.base : to - window.base + 65536])
        try:
            out += unpacker.decompress(piece)
        except zlib.error as error:
            raise Bad("member damaged") from error
        to += len(piece) - len(unpacker.unused_data)
        if len(out) >= 10 and not VERSION.match(out):
            raise Bad("no version line")
    return bytes(out), to


_START = re.compile(re.escape(MEMBER) + rb"|WARC/\d\.\d\r\n")


def head(window: Window, at: int) -> bytes:
    """The bytes of a plain record from `at` to the end of its head, or to where another record or member begins."""
    seen, whole = 1, READ_BYTES
    while True:
        more = window.reach(at + whole)
        begin, end = at - window.base, len(window.held)
        if window.held[begin : begin + 5] != b"WARC/":
            return bytes(window.held[begin : begin + 10])
        stop = window.held.find(b"\r\n\r\n", begin + seen)
        other = _START.search(window.held, begin + seen, stop if stop >= 0 else end)
        if other:
            return bytes(window.held[begin : other.end()])
        if stop >= 0 or not more:
            return bytes(window.held[begin : stop + 4 if stop >= 0 else end])
        seen, whole = max(1, end - begin - 16), 2 * whole


def one_record(window: Window, at: int) -> Found:
    """The record at this byte, or the check that failed."""
    window.reach(at + len(MEMBER))
    if window.held[at - window.base : at - window.base + 3] == MEMBER:
        data, end = inflated(window, at)
        headers, begin, stop = parsed(data)
        if data[stop:] != b"\r\n\r\n":
            raise Bad("length")
        return Found(at, end, "record", headers, checked(headers, data[begin:stop]))
    headers, begin, stop = parsed(head(window, at))
    if not window.reach(at + stop + 4) or window.held[at + stop - window.base : at + stop + 4 - window.base] != b"\r\n\r\n":
        raise Bad("length")
    block = bytes(window.held[at + begin - window.base : at + stop - window.base])
    return Found(at, at + stop + 4, "record", headers, checked(headers, block))


def salvaged(stream) -> Iterator[Found]:
    """Records and gaps of one archive, in order; they cover every byte once."""
    window, at, lost, reason = Window(stream), 0, None, ""
    while window.reach(at + 1):
        try:
            found = one_record(window, at)
        except Bad as error:
            if lost is None:
                lost, reason = at, str(error)
            following = window.find(at + 1, _START, 16)
            at = following if following is not None else window.base + len(window.held)
            continue
        if lost is not None:
            yield Found(lost, at, "gap", reason=reason)
            lost = None
        yield found
        at = found.end
        window.forget(at)
    if lost is not None:
        yield Found(lost, at, "gap", reason=reason)


_ENTRY = pa.schema([
    ("path", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("reason", pa.string()),
    ("headers", pa.map_(pa.string(), pa.string())), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
])
_ENTRY_DDL = "path string, begin long, end long, kind string, reason string, headers map<string,string>, payload_bytes long, payload_digest string, payload binary"


def _entries(folder: str, with_payload: bool):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = file_system(folder)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ENTRY)], schema=_ENTRY)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for x in salvaged(stream):
                        digest = hashlib.sha256(x.payload).hexdigest() if x.kind == "record" else None
                        rows.append((path, x.begin, x.end, x.kind, x.reason, list(x.headers.items()), len(x.payload), digest, x.payload if with_payload else None))
                        size += sum(map(len, x.headers.values())) + (len(x.payload) if with_payload else 0)
                        if size >= READ_BYTES or len(rows) >= 2000:
                            yield batch_of(rows)
                            rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    return of


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """Every record and every gap of all archives of a folder: one row each, with the bytes it takes.

    kind is record or gap; a gap has the reason of the first failed check. One task streams one archive.
    """
    store, path = file_system(folder)
    files = sorted(x.path for x in store.get_file_info(fs.FileSelector(path)) if x.is_file and ".warc" in x.base_name)
    if not files:
        return spark.createDataFrame([], _ENTRY_DDL)
    return spark.createDataFrame([(x,) for x in files], "path string").repartition(len(files)).mapInArrow(_entries(folder, with_payload), _ENTRY_DDL)


def pages_of(entries: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record."""
    header = F.col("headers")
    revisit = header["warc-type"] == "revisit"

    def number(name: str):
        return F.expr(f"try_cast(regexp_extract(headers['{name}'], '^<urn:page:(-?[0-9]+)>$', 1) AS long)")

    return entries.where("kind = 'record'").select(
        number("warc-record-id").alias("page_id"),
        F.when(revisit, header["x-payload-length"].cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.regexp_extract(header["warc-payload-digest"], "^sha256:([0-9a-f]{64})$", 1)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        header["warc-type"].alias("record_type"), number("warc-refers-to").alias("refers_to"),
    )
