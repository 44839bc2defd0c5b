"""WARC archives as seekable Zstandard bundles.

A bundle is a run of independent Zstandard frames, each holding whole records,
and a seek table in a skippable frame at its end.  The index maps every record
to its bundle, its frame and its offset inside the decompressed frame, so one
record is read by decompressing one frame.

Bundles are written to and read from a shared folder; an attempt that fails
leaves a bundle that no index names.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkiln.llm.common import materialize, scratch

FRAME_BYTES = 256_000
BUNDLE_BYTES = 32_000_000
LEVEL = 3
MIN_REVISIT = 1000
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

# Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1


def record(rec_type: str, name: str, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One WARC/1.1 record; a revisit has no payload but keeps its digest and length."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    target = "".join(c for c in url or "" if c not in "\r\n")
    block = HTTP + (payload if rec_type == "response" else b"")
    head = [("WARC-Type", rec_type), ("WARC-Record-ID", f"<urn:page:{name}>"), ("WARC-Target-URI", target), ("WARC-Date", DATE),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(len(payload))),
            ("Content-Type", "application/http; msgtype=response")]
    if refers_to is not None:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    head.append(("Content-Length", str(len(block))))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode("utf-8") + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Header fields, block and end of the record at an offset."""
    stop = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:stop].decode("utf-8").split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"no record at offset {at}")
    head = dict(line.split(": ", 1) for line in lines)
    size = int(head["Content-Length"])
    return head, data[stop + 4 : stop + 4 + size], stop + 8 + size


class BundleWriter:
    """Collects records into frames and closes with the seek table."""

    def __init__(self, out) -> None:
        self.out, self.zip = out, zstandard.ZstdCompressor(level=LEVEL)
        self.frames: list[tuple[int, int]] = []
        self.held: list[bytes] = []
        self.size = self.total = 0

    def add(self, data: bytes) -> tuple[int, int]:
        """Frame and offset of a record."""
        if self.size and self.size + len(data) > FRAME_BYTES:
            self.flush()
        place = len(self.frames), self.size
        self.held.append(data)
        self.size += len(data)
        self.total += len(data)
        return place

    def flush(self) -> None:
        if self.held:
            packed = self.zip.compress(b"".join(self.held))
            self.out.write(packed)
            self.frames.append((len(packed), self.size))
            self.held, self.size = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


class BundleReader:
    """Random access to the frames of a bundle by its seek table."""

    def __init__(self, source) -> None:
        self.source, size = source, source.size()
        source.seek(size - 9)
        count, _, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE:
            raise ValueError("no seek table")
        source.seek(size - 9 - 8 * count)
        entries = struct.unpack(f"<{2 * count}I", source.read(8 * count))
        self.frames, at = [], 0
        for packed, plain in zip(entries[0::2], entries[1::2]):
            self.frames.append((at, packed, plain))
            at += packed

    def frame(self, i: int) -> bytes:
        at, packed, plain = self.frames[i]
        self.source.seek(at)
        return zstandard.ZstdDecompressor().decompress(self.source.read(packed), max_output_size=plain)

    def record(self, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
        return parse_record(self.frame(frame), offset)[:2]


def assign_revisits(df: DataFrame, id_col: str, payload_col: str) -> DataFrame:
    """(id, payload_digest, length, refers_to): of equal payloads of at least ``MIN_REVISIT`` bytes the largest id is
    the one the others refer to.  Only repeated payloads have rows."""
    body = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    keys = df.select(F.col(id_col).alias("id"), F.sha1(body).alias("digest"), F.length(body).alias("length")).filter(F.col("length") >= MIN_REVISIT)
    last = keys.groupBy("digest", "length").agg(F.max("id").alias("last"), F.min("id").alias("first")).filter("first < last")
    return keys.join(last.drop("first"), ["digest", "length"]).filter("id < last").select("id", "digest", F.col("last").alias("refers_to")).distinct()


def write_archives(df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write one record per row below ``folder``; returns the index (id, bundle, frame, offset).

    NULL payloads count as empty.  Rows that repeat an id are written each;
    equal payloads under one id are responses all.  A row without id is a
    response that nothing refers to.
    """
    revisits = assign_revisits(df, id_col, payload_col)
    rows = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(payload_col).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1(F.coalesce("payload", F.lit(b"")))).join(revisits, ["id", "digest"], "left")
    # as strings: pandas holds longs with NULLs as doubles, which round above 2^53
    rows = rows.withColumns({c: F.col(c).cast("string") for c in ("id", "refers_to")})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        writer, bundle, index = None, "", []
        for pdf in batches:
            for name, url, payload, refers in zip(pdf["id"], pdf["url"], pdf["payload"], pdf["refers_to"]):
                if writer is None:
                    bundle = f"{uuid.uuid4().hex}.warc.zst"
                    writer = BundleWriter(store.open_output_stream(f"{root}/{bundle}", compression=None))
                refers = None if pd.isna(refers) else refers
                key = None if pd.isna(name) else int(name)
                data = record("response" if refers is None else "revisit", "none" if key is None else str(key), url, payload or b"", refers)
                index.append((key, bundle, *writer.add(data)))
                if writer.total >= BUNDLE_BYTES:
                    writer.close()
                    writer = None
            yield pd.DataFrame({"id": pd.array([r[0] for r in index], "Int64"), "bundle": [r[1] for r in index],
                                "frame": [r[2] for r in index], "offset": [r[3] for r in index]})
            index = []
        if writer is not None:
            writer.close()

    index = rows.mapInPandas(run, "id long, bundle string, frame long, offset long")
    return materialize(index, "warc-index").withColumnRenamed("id", id_col)


def read_archives(index: DataFrame, folder: str, id_col: str = "page_id") -> DataFrame:
    """(id, payload_bytes, payload_digest, record_type, refers_to) of every indexed record, read from its frame.

    A response's digest and length are taken from the payload read, and must be those of its header.
    """
    wanted = index.groupBy("bundle", "frame").agg(F.sort_array(F.collect_list("offset")).alias("offsets"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = fs.FileSystem.from_uri(folder)
        for pdf in batches:
            out = []
            for bundle, group in pdf.groupby("bundle"):
                with store.open_input_file(f"{root}/{bundle}") as source:
                    reader = BundleReader(source)
                    for frame, offsets in zip(group["frame"], group["offsets"]):
                        data = reader.frame(frame)
                        for at in offsets:
                            out.append(_facts(*parse_record(data, at)[:2]))
            yield pd.DataFrame({c: pd.array([r[i] for r in out], t) for i, (c, t) in enumerate(
                [("id", "Int64"), ("payload_bytes", "Int64"), ("payload_digest", "string"), ("record_type", "string"), ("refers_to", "Int64")])})

    return wanted.mapInPandas(run, "id long, payload_bytes long, payload_digest string, record_type string, refers_to long").withColumnRenamed("id", id_col)


def _facts(head: dict[str, str], block: bytes) -> tuple:
    def page(field: str) -> int | None:
        name = head.get(field, "<urn:page:none>")[len("<urn:page:") : -1]
        return None if name == "none" else int(name)

    digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    size = int(head["X-Payload-Length"])
    if head["WARC-Type"] == "response":
        payload = block[len(HTTP) :]
        if hashlib.sha1(payload).hexdigest() != digest or len(payload) != size:
            raise ValueError(f"damaged record {head['WARC-Record-ID']}")
    return page("WARC-Record-ID"), size, digest, head["WARC-Type"], page("WARC-Refers-To")


def archive_round_trip(df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write all rows into archives in the shared folder and read them back."""
    folder = scratch(df.sparkSession, "warc")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    return read_archives(write_archives(df, folder, id_col, url_col, payload_col), folder, id_col)
