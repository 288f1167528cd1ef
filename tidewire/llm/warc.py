"""WARC archives compressed with a Zstandard dictionary: one record per page, repeats as revisits."""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import columns_of, slices
from tidewire.operators.lookup import lookup
from tidewire.session import settle, shared_dir

# The dictionary of an archive is trained on its first records, up to so many bytes.
SAMPLE_BYTES, DICTIONARY_BYTES = 1 << 20, 32 << 10
MAX_ARCHIVE_BYTES = 64 << 20
LEVEL = 3
MIN_REVISIT_BYTES = 0
# Lengths of the samples that a dictionary is trained on; the next if there are too few of the first.
SAMPLE_PIECES = (4096, 512, 64)
# Fixed values of the format: a skippable frame with this magic number leads with the dictionary.
_DICTIONARY_MAGIC, _ZSTD_MAGIC, _SKIPPABLE = 0x184D2A5D, 0xFD2FB528, range(0x184D2A50, 0x184D2A60)
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_PAGE = "urn:page:"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    """The same id for the same page, so that a revisit can name the record of another page."""
    return f"<{(uuid.uuid4() if page_id is None else uuid.uuid5(uuid.NAMESPACE_URL, f'{_PAGE}{page_id}')).urn}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A WARC/1.1 record. A revisit keeps digest and length of the payload, not the payload."""
    http = _HTTP % len(payload)
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}", f"X-Payload-Length: {len(payload)}",
        f"Content-Length: {len(block)}"]
    if page_id is not None:
        lines.append(f"X-Page-ID: <{_PAGE}{page_id}>")
    if url is not None:
        lines.append("WARC-Target-URI: " + " ".join(url.split()))
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page: <{_PAGE}{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train_dictionary(records: list[bytes], size: int = DICTIONARY_BYTES) -> bytes | None:
    """A dictionary of the records, or None if they are too little to train on.

    Training wants many samples, so records are cut into pieces: a few large ones serve as well as many small ones.
    """
    for piece in SAMPLE_PIECES:
        try:
            samples = [r[k:k + piece] for r in records for k in range(0, len(r), piece)]
            return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
        except zstandard.ZstdError:
            continue
    return None


class ArchiveWriter:
    """One archive: a dictionary in a leading skippable frame, then a frame per record."""

    def __init__(self, files: fs.FileSystem, path: str):
        # The name would have the whole stream compressed once more, and no frame of it would be the dictionary's.
        self.path, self.out = path, files.open_output_stream(path, compression=None)
        self.waiting: list[bytes] = []
        self.held = self.written = 0
        self.compress = None

    def add(self, content: bytes) -> None:
        if self.compress:
            self._write(self.compress(content))
        else:
            self.waiting.append(content)
            self.held += len(content)
            if self.held >= SAMPLE_BYTES:
                self._start()

    def _write(self, frame: bytes) -> None:
        self.written += self.out.write(frame)

    def _start(self) -> None:
        trained = train_dictionary(self.waiting)
        if trained:
            self._write(struct.pack("<II", _DICTIONARY_MAGIC, len(trained)) + trained)
        shared = zstandard.ZstdCompressionDict(trained) if trained else None
        self.compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared).compress
        for content in self.waiting:
            self._write(self.compress(content))
        self.waiting = []

    def close(self) -> None:
        if not self.compress:
            self._start()
        self.out.close()


def _frame_records(stream: io.RawIOBase) -> Iterator[bytes]:
    """The records of an archive, one at a time."""
    head, shared = stream.read(8), None
    magic, size = struct.unpack("<II", head) if len(head) == 8 else (0, 0)
    pending = head
    if magic in _SKIPPABLE:
        content, pending = stream.read(size), b""
        if magic == _DICTIONARY_MAGIC:
            if content[:4] == struct.pack("<I", _ZSTD_MAGIC):  # the format lets a dictionary be compressed itself
                content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
            shared = zstandard.ZstdCompressionDict(content)
    decompressor = zstandard.ZstdDecompressor(dict_data=shared)
    frame, parts = decompressor.decompressobj(), []
    while True:
        chunk = pending or stream.read(1 << 20)
        if not chunk:
            break
        pending = b""
        while chunk:
            parts.append(frame.decompress(chunk))
            chunk = b""
            if frame.eof:
                yield b"".join(parts)
                chunk, frame, parts = frame.unused_data, decompressor.decompressobj(), []


def parse_record(content: bytes) -> dict:
    """Headers (names in lower case) and block of a record."""
    head, _, rest = content.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}
    return {"version": lines[0], "headers": headers, "block": rest[:int(headers["content-length"])]}


def _page_of(value: str | None) -> int | None:
    return int(value.strip("<>").removeprefix(_PAGE)) if value else None


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                   min_revisit_bytes: int = MIN_REVISIT_BYTES, max_bytes: int = MAX_ARCHIVE_BYTES) -> DataFrame:
    """Write a WARC record per page to ``folder``, a URI that all executors reach; returns the manifest.

    Of pages with equal payloads (html in UTF-8, null: empty) of at least ``min_revisit_bytes`` the one with the
    smallest page id is a response and the others revisit it; all smaller payloads are responses. A repeated
    row with that id is a response as well. A null id never is the smallest; if all ids of a group are null, all
    its records are responses.

    Pages are archived where they are read. Only digests are shuffled, with partial sums, and the payloads that
    occur several times are looked up by digest. Every archive trains its own dictionary on its first records,
    has about ``max_bytes`` at most, and a new name, so a task that runs again leaves a file that no manifest
    names. The manifest, ``path, n_records``, is stored before it is returned. Other columns are ignored.
    """
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html), F.lit("")).alias("html")).withColumn(
            "digest", F.sha1(F.encode("html", "UTF-8")))
    firsts = settle(rows.filter(F.octet_length("html") >= min_revisit_bytes).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first"))
    told = lookup(rows, firsts, "digest", "page_id").withColumn(
        "revisit", F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = fs.FileSystem.from_uri(folder)
        paths, counts, archive = [], [], None
        for batch in slices(batches, "html"):
            for page, target, text, first, revisit in zip(*columns_of(batch, "page_id", "url", "html", "first", "revisit")):
                if archive is None:
                    files.create_dir(base, recursive=True)
                    archive = ArchiveWriter(files, f"{base}/{uuid.uuid4().hex}.warc.zst")
                    paths.append(archive.path.rsplit("/", 1)[1])
                    counts.append(0)
                archive.add(record(page, target, text.encode(), first, revisit))
                counts[-1] += 1
                if archive.written >= max_bytes:
                    archive.close()
                    archive = None
        if archive:
            archive.close()
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(counts, pa.int64())], names=["path", "n_records"])

    return settle(told.mapInArrow(write, "path string, n_records long"))


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """The records of the archives in a manifest, read as streams, a record at a time.

    Columns: ``page_id, record_type, payload_bytes, payload_digest, refers_to, url, payload, path``. ``payload``
    is null for revisits. Digest and length of a response are taken from its payload and must agree with its headers.
    """
    count = manifest.count()
    dealt = manifest.select("path").repartitionByRange(max(1, count), "path") if count else manifest.select("path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with files.open_input_stream(f"{base}/{path}", compression=None) as stream:
                    for content in _frame_records(stream):
                        rows.append((*_read_row(content), path))
                        held += len(content)
                        if held >= 4_000_000:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return dealt.mapInArrow(read, ", ".join(f"{name} {kind}" for name, kind, _ in _COLUMNS))


_COLUMNS = [
    ("page_id", "long", pa.int64()), ("record_type", "string", pa.string()), ("payload_bytes", "long", pa.int64()),
    ("payload_digest", "string", pa.string()), ("refers_to", "long", pa.int64()), ("url", "string", pa.string()),
    ("payload", "binary", pa.binary()), ("path", "string", pa.string())]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kind) for values, (_, _, kind) in zip(zip(*rows), _COLUMNS)], names=[c[0] for c in _COLUMNS])


def _read_row(content: bytes) -> tuple:
    parsed = parse_record(content)
    headers, block = parsed["headers"], parsed["block"]
    kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
    size, payload = int(headers["x-payload-length"]), None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if len(payload) != size or payload_digest(payload) != digest:
            raise ValueError(f"the payload of {headers['warc-record-id']} does not agree with its headers")
    return (_page_of(headers.get("x-page-id")), kind, size, digest, _page_of(headers.get("x-refers-to-page")),
            headers.get("warc-target-uri"), payload)


def archive_folder(pages: DataFrame) -> str:
    """A new folder for archives in the shared one."""
    return f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
