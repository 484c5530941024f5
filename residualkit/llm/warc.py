"""WARC archives in Zstandard: one frame per record, the dictionary in a leading skippable frame.

Layout of an archive: a skippable frame (magic 0x184D2A5D) that holds the
dictionary, then one Zstandard frame for each WARC/1.1 record. The dictionary is
trained on the first payloads of the archive; where they are too few to train
on, their text itself is the dictionary.

Archives are written by the tasks that hold the rows, a bounded number of
records and bytes each, below the shared checkpoint folder and under names that no other
attempt uses; records are written as rows arrive, so a task holds one batch of
rows and the compressed output of one record. What counts is the table of the archives, written by Spark with its own commit: files of lost attempts
are in no table and are not read. The reader goes through a file frame by frame
and checks every record: version, required headers, block length, terminator,
one record a frame, and the digest of a full payload.

Archives of other writers can be read as well: every record type, WARC/1.0, records
without a payload digest or with one of another algorithm, headers given more than once,
folded or in another case, truncated and transfer-encoded payloads, blocks that are not HTTP,
a dictionary frame that is itself compressed, or none. Such records have no page id.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residualkit.llm.frames import first_columns, known, stage_python
from residualkit.staging import stage, staged_folder

# Fixed values of the formats.
SKIPPABLE_DICTIONARY = 0x184D2A5D
VERSION = b"WARC/1.1"
VERSIONS = (VERSION, b"WARC/1.0")
FRAME = 0xFD2FB528
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
DIGESTS = {"sha1": hashlib.sha1, "sha256": hashlib.sha256, "sha512": hashlib.sha512, "md5": hashlib.md5}

RECORDS, ARCHIVE_BYTES = 4096, 256 << 20
ROWS = 256
SAMPLES, SAMPLE_BYTES, DICTIONARY_BYTES = 256, 4096, 65536
FED = 1 << 14
DATE = "2024-01-01T00:00:00Z"
_IDS = uuid.UUID("8f2b6d50-0000-4000-8000-000000000000")


def record_id(page_id: int | None) -> str:
    """A record's URN; its upper 64 bits are the page id, and can be read back."""
    if page_id is None:
        return f"urn:uuid:{uuid.uuid4()}"
    return f"urn:uuid:{uuid.UUID(int=(page_id & (1 << 64) - 1) << 64 | _IDS.int & (1 << 64) - 1)}"


def page_of(urn: str) -> int | None:
    """The page id in a record's URN; None for the names that other writers give."""
    try:
        value = uuid.UUID(urn.rpartition(":")[2]).int
    except ValueError:
        return None
    if value & (1 << 64) - 1 != _IDS.int & (1 << 64) - 1:
        return None
    high = value >> 64
    return high - (1 << 64) if high >> 63 else high


@dataclass(frozen=True)
class Record:
    """A record as read back.

    ``payload`` is the HTTP body, or the whole block where that is not HTTP, and None for
    revisits. ``payload_bytes`` of a revisit is what its HTTP header says, ``digest`` the SHA-1 in
    hex: of the payload, or of a revisit what its header says. Both are None where nothing says it.
    """

    headers: dict[str, str]
    payload: bytes | None
    payload_bytes: int | None
    digest: str | None


def header_text(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c >= " " else "%%%02X" % ord(c) for c in value)


def write_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, digest: str) -> bytes:
    """A response record, or a revisit of the page ``refers_to`` without the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{record_id(page_id)}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", header_text(url or "")),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{record_id(refers_to)}>")]
    head = "".join(f"{k}: {v}\r\n" for k, v in headers).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def _header_lines(lines: list[bytes]) -> Iterator[tuple[str, str]]:
    """Names and values of header lines, folded ones joined."""
    name, value = "", ""
    for line in lines:
        text = line.decode("utf-8", "replace")
        if name and text[:1] in (" ", "\t"):
            value += " " + text.strip()
            continue
        if name:
            yield name, value
        name, colon, value = text.partition(":")
        name, value = name.strip(), value.strip()
        if not colon or not name:
            raise ValueError(f"bad header line {line[:80]!r}")
    if name:
        yield name, value


def record_headers(lines: list[bytes]) -> dict[str, str]:
    """The headers of a record. Known names get their usual case; values of a header given more than once are joined by commas.

    A required header given twice with two values is an error.
    """
    usual = {n.lower(): n for n in (*REQUIRED, "WARC-Payload-Digest", "WARC-Target-URI", "WARC-Refers-To", "Content-Type", "WARC-Truncated")}
    headers: dict[str, str] = {}
    for given, value in _header_lines(lines):
        name = usual.get(given.lower(), given)
        if name not in headers:
            headers[name] = value
        elif headers[name] != value:
            if name in REQUIRED:
                raise ValueError(f"two values of {name}")
            headers[name] += ", " + value
    missing = [name for name in REQUIRED if name not in headers]
    if missing:
        raise ValueError(f"missing headers {missing}")
    return headers


def _digest_bytes(algorithm: str, value: str) -> bytes:
    """The digest a header states, in base 32 or in hex."""
    size = DIGESTS[algorithm]().digest_size
    if len(value) == 2 * size:
        return bytes.fromhex(value)
    return base64.b32decode(value.upper() + "=" * (-len(value) % 8))


def parse_record(raw: bytes) -> Record:
    """Check a record and take it apart; raises ValueError if anything is wrong.

    A payload is held against its HTTP length unless it is truncated or transfer-encoded, and against its
    digest if there is one of a known algorithm, unless it is transfer-encoded.
    """
    head, gap, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if version not in VERSIONS or not gap:
        raise ValueError("not a WARC record")
    headers = record_headers(lines)
    if not headers["Content-Length"].isdecimal():
        raise ValueError(f"Content-Length {headers['Content-Length']!r}")
    length = int(headers["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"block of {len(rest) - 4} bytes, Content-Length {length}")
    block, kind = rest[:length], headers["WARC-Type"].lower()
    headers["WARC-Type"] = kind
    fields: dict[str, str] = {}
    payload = block
    if headers.get("Content-Type", "").lower().startswith("application/http"):
        http, gap, payload = block.partition(b"\r\n\r\n")
        if not gap and kind != "revisit" and "WARC-Truncated" not in headers:
            raise ValueError("no HTTP header")
        fields = {n.lower(): v for n, v in _header_lines(http.removesuffix(b"\r\n").split(b"\r\n")[1:])}
    stated = fields.get("content-length", "")
    size = int(stated) if stated.isdecimal() else None
    algorithm, _, value = headers.get("WARC-Payload-Digest", "").partition(":")
    algorithm = algorithm.lower().replace("-", "")
    if kind == "revisit":
        if payload or "WARC-Refers-To" not in headers and "WARC-Payload-Digest" not in headers:
            raise ValueError("a revisit with a payload, or without what it refers to")
        return Record(headers, None, size, _digest_bytes(algorithm, value).hex() if algorithm == "sha1" else None)
    encoded = "transfer-encoding" in fields
    if kind == "response" and size not in (None, len(payload)) and not encoded and "WARC-Truncated" not in headers:
        raise ValueError(f"payload of {len(payload)} bytes, its header says {size}")
    if algorithm in DIGESTS and not encoded and DIGESTS[algorithm](payload).digest() != _digest_bytes(algorithm, value):
        raise ValueError("payload and its digest disagree")
    return Record(headers, payload, len(payload), hashlib.sha1(payload).hexdigest())


def make_dictionary(payloads: list[bytes]) -> bytes:
    samples = [p[:SAMPLE_BYTES] for p in payloads[:SAMPLES] if p]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-DICTIONARY_BYTES:]


class ArchiveWriter:
    """Writes the dictionary frame at once and one frame for each record added."""

    def __init__(self, target, dictionary: bytes) -> None:
        self.target, self.records, self.raw_bytes = target, 0, 0
        self.written = target.write(
            SKIPPABLE_DICTIONARY.to_bytes(4, "little") + len(dictionary).to_bytes(4, "little") + dictionary
        )
        dict_data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=dict_data, write_checksum=True)

    def add(self, raw: bytes) -> None:
        self.written += self.target.write(self.compressor.compress(raw))
        self.records += 1
        self.raw_bytes += len(raw)


def write_archive(target, records: list[bytes], dictionary: bytes) -> int:
    """Write the dictionary frame and one frame per record; returns the bytes written."""
    writer = ArchiveWriter(target, dictionary)
    for raw in records:
        writer.add(raw)
    return writer.written


def _exactly(source, size: int) -> bytes:
    """That many bytes; fewer are an error."""
    pieces, left = [], size
    while left:
        piece = source.read(left)
        if not piece:
            raise ValueError("the archive is cut off")
        pieces.append(bytes(piece))
        left -= len(piece)
    return b"".join(pieces)


def _frames(source, begun: bytes, decompressor: zstandard.ZstdDecompressor, chunk: int) -> Iterator[bytes]:
    """The decoded frames of a stream whose first bytes are ``begun``.

    Input is fed in slices of at most ``FED`` bytes, so that what follows the end of a frame in its slice stays short.
    """
    view, at = memoryview(begun), 0

    def more(message: str | None) -> bool:
        nonlocal view, at
        if at == len(view):
            view, at = memoryview(source.read(chunk)), 0
            if not len(view) and message is not None:
                raise ValueError(message)
        return len(view) > 0

    while more(None):
        frame, pieces = decompressor.decompressobj(), []
        while not frame.eof:
            more("the last frame is cut off")
            fed = view[at : at + FED]
            pieces.append(frame.decompress(fed))
            at += len(fed) - len(frame.unused_data)
        yield b"".join(pieces)


def read_archive(source, chunk: int = 1 << 20, need_dictionary: bool = True) -> Iterator[bytes]:
    """The decoded records of an archive, one frame at a time.

    A dictionary frame may hold the dictionary itself or a Zstandard frame of it. With
    ``need_dictionary`` an archive without one is an error.
    """
    head = source.read(4)
    if not need_dictionary and not head:
        return
    head += _exactly(source, 4 - len(head))
    dictionary, begun = b"", head
    if int.from_bytes(head, "little") == SKIPPABLE_DICTIONARY:
        dictionary, begun = _exactly(source, int.from_bytes(_exactly(source, 4), "little")), b""
        if int.from_bytes(dictionary[:4], "little") == FRAME:
            dictionary = zstandard.ZstdDecompressor().decompressobj().decompress(dictionary)
    elif need_dictionary:
        raise ValueError("no dictionary frame at the start")
    dict_data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    yield from _frames(source, begun, zstandard.ZstdDecompressor(dict_data=dict_data), chunk)


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """A file system and a path in it; a path without a scheme is local."""
    if not urlsplit(uri).scheme:
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return pafs.FileSystem.from_uri(uri)


ARCHIVES = "archive string, records long, bytes long"


def _write(batches: Iterator[pa.RecordBatch], folder: str, per_archive: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Write rows to archives; a new one is begun after ``per_archive`` records or ``most_bytes`` bytes of records."""
    fs, path = file_system(folder)
    fs.create_dir(path, recursive=True)
    open_now: tuple[str, ArchiveWriter] | None = None

    def close() -> pa.RecordBatch:
        nonlocal open_now
        name, writer = open_now
        writer.target.close()
        open_now = None
        return pa.RecordBatch.from_arrays(
            [pa.array([f"{folder}/{name}"]), pa.array([writer.records]), pa.array([writer.written])],
            names=["archive", "records", "bytes"],
        )

    for batch in batches:
        rows = batch.to_pydict()
        payloads = [h.encode() for h in rows["html"]]
        for i, payload in enumerate(payloads):
            if open_now is None:
                name = f"{uuid.uuid4().hex}.warc.zst"
                target = fs.open_output_stream(f"{path}/{name}", compression=None)  # the name would ask for another layer
                open_now = name, ArchiveWriter(target, make_dictionary(payloads[i : i + SAMPLES]))
            writer = open_now[1]
            writer.add(write_record(rows["page_id"][i], rows["url"][i], payload, rows["refers_to"][i], rows["digest"][i]))
            if writer.records >= per_archive or writer.raw_bytes >= most_bytes:
                yield close()
    if open_now is not None:
        yield close()


READ = "archive string, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


def _read(batches: Iterator[pa.RecordBatch], payloads: bool, need_dictionary: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive in batch.column(0).to_pylist():
            fs, path = file_system(archive)
            rows: list[tuple] = []
            held = 0
            with fs.open_input_stream(path, compression=None) as source:
                for raw in read_archive(source, need_dictionary=need_dictionary):
                    record = parse_record(raw)
                    h = record.headers
                    refers = h.get("WARC-Refers-To")
                    row = (
                        archive,
                        page_of(h["WARC-Record-ID"].strip("<>")),
                        h.get("WARC-Target-URI"),
                        h["WARC-Type"],
                        page_of(refers.strip("<>")) if refers else None,
                        record.payload_bytes,
                        record.digest,
                    )
                    rows.append((*row, record.payload) if payloads else row)
                    held += len(raw) if payloads else 200
                    if held > 8 << 20:
                        yield _batch(rows, payloads)
                        rows, held = [], 0
            if rows:
                yield _batch(rows, payloads)


def _batch(rows: list[tuple], payloads: bool) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = ["archive", "page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"]
    if payloads:
        kinds, names = [*kinds, pa.binary()], [*names, "payload"]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def plan_records(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """``page_id, url, html, digest, refers_to``: the records to write.

    Of equal payloads of at least ``min_bytes`` bytes, the one with the largest
    id is written in full and the others refer to it. NULL html is empty. Rows
    that repeat the largest id are all written in full. A NULL id is never the
    largest, unless all are NULL; then all are written in full.
    """
    rows = first_columns(pages, ["page_id", "url", "html"]).select(
        F.col("page_id").cast("long").alias("page_id"), "url", known("html").alias("html")
    )
    hashed = rows.select("*", F.sha1(F.encode("html", "UTF-8")).alias("digest"), F.octet_length("html").alias("size"))
    groups = hashed.filter(F.col("size") >= min_bytes).groupBy("digest", "size").agg(
        F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")
    )
    copies = stage(groups.filter("n > 1 and first is not null").select("digest", "size", "first"), "payload_copies")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return hashed.join(copies, ["digest", "size"], "left").select("page_id", "url", "html", "digest", refers.alias("refers_to"))


def write_archives(
    records: DataFrame, folder: str, per_archive: int = RECORDS, most_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write planned records below ``folder``; returns the staged table of the archives.

    An archive ends after ``per_archive`` records, or with the record that brings them to ``most_bytes`` bytes.
    """
    write = partial(_write, folder=folder, per_archive=per_archive, most_bytes=most_bytes)
    return stage_python(records.mapInArrow(write, ARCHIVES), "archives", ROWS)


def read_archives(archives: DataFrame, payloads: bool = False, need_dictionary: bool = True) -> DataFrame:
    """The checked records of the archives named in column ``archive``; ``payloads`` adds the bytes.

    A broken archive is an error. An empty table of archives gives no records. Records of other writers are returned like
    any other, with a NULL page id; ``need_dictionary=False`` also takes archives without a dictionary frame.
    """
    tasks = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = archives.select("archive").repartition(tasks, "archive")
    return dealt.mapInArrow(partial(_read, payloads=payloads, need_dictionary=need_dictionary), READ + (", payload binary" if payloads else ""))


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write one record per page, read the archives back, and return what was read."""
    folder = f"{staged_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    read = read_archives(write_archives(plan_records(pages), folder))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
