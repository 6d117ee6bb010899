"""WARC archives with per-record Zstandard frames and an embedded dictionary.

Layout of a file: a skippable frame (magic ``0x184D2A5D``) that holds the
dictionary, then one Zstandard frame per WARC record. The dictionary is built
from the first ``SAMPLE_BYTES`` of the file's own records (documented bound of
the fit), so every file reads alone. Records that repeat a payload of
at least ``MIN_REVISIT`` bytes become ``revisit`` records that name the one
response; a payload is stored once.

A task streams its rows into files of at most ``FILE_BYTES`` and returns a
manifest row per finished file. Names carry a random part, so a task that is
run again, or twice at a time, never touches another attempt's file; only
files in the written manifest count.

Null and edge cases: a null html is an empty payload; a null url has no
target header; control and non-ASCII characters of a url are
percent-encoded; a null ``page_id`` never wins a group, and is a response
unless an id in its group wins; rows that repeat the winner's id are all responses. Extra columns
are ignored. An empty table gives no file and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import written
from shoplake.session import scratch_dir

MIN_REVISIT = 1000
SAMPLE_BYTES = 2 << 20
DICT_BYTES = 64 << 10
FILE_BYTES = 1 << 30
DICT_MAGIC = 0x184D2A5D
LEVEL = 3
WARC_DATE = "2026-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:page:"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def plan_records(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, n, sha1, refers_to``; payload is null for revisits."""
    body = F.encode(F.coalesce(F.col("html"), F.lit("")), "utf-8")
    p = pages.select("page_id", "url", body.alias("payload")).withColumn("n", F.length("payload").cast("bigint"))
    p = p.withColumn("sha1", F.sha1("payload")).withColumn("same", F.when(F.col("n") >= MIN_REVISIT, F.sha2("payload", 256)))
    groups = p.where("same is not null").groupBy("same", "n").agg(F.max("page_id").alias("winner"), F.count(F.lit(1)).alias("copies"))
    j = p.join(groups.where("copies > 1").drop("copies"), ["same", "n"], "left")
    again = F.col("winner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("winner"))
    return j.select(
        "page_id", "url", F.when(~again, F.col("payload")).alias("payload"), "n", "sha1", F.when(again, F.col("winner")).alias("refers_to")
    )


def record_bytes(page_id, url, payload, n, sha1, refers_to) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {'response' if payload is not None else 'revisit'}", f"WARC-Record-ID: <{ID_PREFIX}{page_id}>"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%/:=&?~#+!$,;'@()*[]"))
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    head += [f"WARC-Date: {WARC_DATE}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    block = HTTP_HEAD % n + (payload or b"")
    if payload is None:
        head += [f"WARC-Refers-To: <{ID_PREFIX}{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("ascii") + b"\r\n\r\n" + block + b"\r\n\r\n"


def train_dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A trained dictionary, or the samples' own start where there are too few to train on."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples, k=200, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[:DICT_BYTES].ljust(8, b"\0"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def _to_int(v):
    return None if v is None or v != v else int(v)


class _ArchiveFile:
    """One archive: records wait until the dictionary's sample is full, then stream."""

    def __init__(self, folder: str):
        fs, base = pafs.FileSystem.from_uri(folder)
        self.fs, self.name = fs, f"{base}/{uuid.uuid4().hex}.warc.zst"
        self.out, self.packer, self.waiting, self.wait_bytes, self.n, self.size = None, None, [], 0, 0, 0

    def add(self, rec: bytes) -> None:
        self.n += 1
        if self.packer is None:
            self.waiting.append(rec)
            self.wait_bytes += len(rec)
            if self.wait_bytes >= SAMPLE_BYTES:
                self._start()
        else:
            self._put(self.packer.compress(rec))

    def _put(self, b: bytes) -> None:
        self.out.write(b)
        self.size += len(b)

    def _start(self) -> None:
        d = train_dictionary(self.waiting)
        self.packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=d)
        self.out = self.fs.open_output_stream(self.name, compression=None)
        raw = d.as_bytes()
        self._put(struct.pack("<II", DICT_MAGIC, len(raw)) + raw)
        for rec in self.waiting:
            self._put(self.packer.compress(rec))
        self.waiting = []

    def close(self) -> tuple[str, int, int]:
        if self.packer is None:
            self._start()
        self.out.close()
        return self.name.rpartition("/")[2], self.n, self.size


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Writes the archives under ``folder`` (any file system that pyarrow opens); returns ``file, n_records, n_bytes``."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        archive, done = None, []
        for b in batches:
            for page_id, url, payload, n, sha1, refers_to in zip(b.page_id, b.url, b.payload, b.n, b.sha1, b.refers_to):
                archive = archive or _ArchiveFile(folder)
                archive.add(record_bytes(_to_int(page_id), url, payload, n, sha1, _to_int(refers_to)))
                if archive.size >= FILE_BYTES:
                    done.append(archive.close())
                    archive = None
        if archive:
            done.append(archive.close())
        yield pd.DataFrame(done, columns=["file", "n_records", "n_bytes"])

    pafs_ready(folder)
    ids = records.withColumns({c: F.col(c).cast("decimal(20,0)") for c in ("page_id", "refers_to")})  # exact in pandas, nulls too
    return written(ids.mapInPandas(write, "file string, n_records long, n_bytes long"), "warc-manifest")


def pafs_ready(folder: str) -> None:
    fs, base = pafs.FileSystem.from_uri(folder)
    fs.create_dir(base, recursive=True)


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of one archive."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICT_MAGIC:
        raise ValueError("the archive does not begin with a dictionary frame")
    d = zstandard.ZstdCompressionDict(stream.read(size))
    reader = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=d).stream_reader(stream, read_across_frames=True), 1 << 20)
    while reader.readline():
        head = {}
        while line := reader.readline().strip():
            k, _, v = line.decode("ascii").partition(": ")
            head[k] = v
        block = reader.read(int(head["Content-Length"]))
        reader.read(4)
        yield head, block


def read_archives(manifest: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """One row per record: ids, type, target, payload length and digest (recomputed for responses), payload."""
    cols = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", *(["payload"] if with_payload else [])]

    def page(ref: str | None):
        ref = (ref or "").strip("<>").removeprefix(ID_PREFIX)
        return int(ref) if ref not in ("", "None") else None

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = pafs.FileSystem.from_uri(folder)
        for b in batches:
            for name in b.file:
                rows, held = [], 0
                with fs.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for head, block in read_records(stream):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        stated = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                        n = int(http.rpartition(b": ")[2])
                        if head["WARC-Type"] == "response" and (len(payload) != n or hashlib.sha1(payload).hexdigest() != stated):
                            raise ValueError(f"record {head['WARC-Record-ID']} of {name} does not match its digest")
                        row = (page(head["WARC-Record-ID"]), head.get("WARC-Target-URI"), head["WARC-Type"], page(head.get("WARC-Refers-To")), n, stated)
                        rows.append((*row, payload) if with_payload else row)
                        held += len(payload) if with_payload else 0
                        if len(rows) >= 10_000 or held >= 16 << 20:
                            yield pd.DataFrame(rows, columns=cols).astype({"page_id": object, "refers_to": object})
                            rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=cols).astype({"page_id": object, "refers_to": object})

    schema = "page_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string"

    def as_text(batches):
        for out in read(batches):
            for c in ("page_id", "refers_to"):
                out[c] = [None if v is None or v != v else str(int(v)) for v in out[c]]
            yield out

    files = manifest.repartition(max(1, manifest.count()), "file")  # a task per file
    got = files.mapInPandas(as_text, schema + (", payload binary" if with_payload else ""))
    return got.withColumns({c: F.col(c).cast("bigint") for c in ("page_id", "refers_to")})


def archive_pages(pages: DataFrame) -> DataFrame:
    """Writes every page, reads the archives back, one row per page."""
    folder = scratch_dir(pages.sparkSession, "warc")
    manifest = write_archives(plan_records(pages), folder)
    return read_archives(manifest, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
