"""WARC records in seekable Zstandard bundles.

Records are grouped into frames that decompress independently; a bundle is a run of frames with a seek table as the
footer (a skippable frame with the sizes of all frames, in the public seekable format). The record index maps each
record identifier to bundle, frame, offset and length inside the decompressed frame, so one record costs one frame.

Of records with equal payloads of at least `REVISIT_BYTES` bytes the one with the smallest id is a response, the
others are revisits that carry no payload but refer to it. Tasks write their own bundles into the shared folder under
names of their own and return the index rows; bundles of a lost task are in no index.

Defined results: a null payload is empty, a null address is the empty text. Rows without id are responses under an
empty identifier. Repeated rows share the id: all of them are responses if the first is. Columns beyond the three
named ones are not archived. An empty table writes nothing.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import Batches, texts
from voltframe.session import scratch_folder, written

REVISIT_BYTES = 100
FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 64 << 20
LEVEL = 3
# Fixed values of the seekable format: magic numbers of a skippable frame and of the seek table's footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
# Pages carry no time of capture.
DATE = "1970-01-01T00:00:00Z"


def record(page: int | None, url: str, kind: str, refers: int | None, digest: str, size: int, payload: bytes) -> bytes:
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        f"WARC-Target-URI: {quote(url, safe=' %:/?#[]@!$&()*+,;=~')}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Payload-Length: {size}",
    ]
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{refers}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        payload = b""
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    size = int(headers["Content-Length"])
    if first != "WARC/1.1" or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"not a whole record: {headers.get('WARC-Record-ID')}")
    return headers, rest[:size]


class Bundle:
    """Collects records into frames and writes them with the seek table."""

    def __init__(self, path: str) -> None:
        self.path, self.sizes, self.frame, self.held, self.total = path, [], [], 0, 0
        store, self.place = fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)
        self.file = store.open_output_stream(self.place, compression=None)

    def add(self, data: bytes) -> tuple[int, int]:
        """Frame number and offset of the record."""
        if self.held and self.held + len(data) > FRAME_BYTES:
            self.flush()
        at = len(self.sizes), self.held
        self.frame.append(data)
        self.held += len(data)
        return at

    def flush(self) -> None:
        if self.frame:
            packed = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True).compress(b"".join(self.frame))
            self.file.write(packed)
            self.sizes.append((len(packed), self.held))
            self.total += len(packed)
            self.frame, self.held = [], 0

    def close(self) -> None:
        self.flush()
        self.file.write(seek_table(self.sizes))
        self.file.close()


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", *pair) for pair in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


class Reader:
    """Frames of a bundle by number, found through the seek table at its end."""

    def __init__(self, path: str) -> None:
        store, place = fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)
        self.file = store.open_input_file(place)
        end = self.file.size()
        count, _, magic = struct.unpack("<IBI", self._read(end - 9, 9))
        if magic != SEEKABLE:
            raise ValueError(f"no seek table in {path}")
        pairs = list(struct.iter_unpack("<II", self._read(end - 9 - 8 * count, 8 * count)))
        self.starts = [0]
        for packed, _ in pairs:
            self.starts.append(self.starts[-1] + packed)
        self.sizes = [size for _, size in pairs]
        self.number, self.data = -1, b""

    def _read(self, start: int, size: int) -> bytes:
        self.file.seek(start)
        return self.file.read(size)

    def frame(self, number: int) -> bytes:
        if number != self.number:
            packed = self._read(self.starts[number], self.starts[number + 1] - self.starts[number])
            self.number, self.data = number, zstandard.ZstdDecompressor().decompress(packed, self.sizes[number])
        return self.data


def decided(pages: DataFrame, id: str, url: str, payload: str) -> DataFrame:
    """page, url, payload (empty for revisits), digest, size, kind and refers of every record."""
    rows = pages.select(
        F.col(id).alias("page"), F.coalesce(F.col(url), F.lit("")).alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("payload")
    )
    rows = rows.withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256)).withColumn("size", F.octet_length("payload").cast("long"))
    # Only shared payloads are joined back; both sides are exchanged, so a payload of very many pages can be split.
    large = rows.filter((F.col("size") >= REVISIT_BYTES) & F.col("page").isNotNull())
    shared = large.groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    joined = rows.join(written(shared, "payloads"), "digest", "left")
    revisit = F.coalesce(F.col("first") < F.col("page"), F.lit(False))
    return joined.select(
        "page", "url", F.when(revisit, "").otherwise(F.col("payload")).alias("payload"), "digest", "size",
        F.when(revisit, "revisit").otherwise("response").alias("kind"), F.when(revisit, F.col("first")).alias("refers"),
    )


def archive(pages: DataFrame, folder: str, id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write the bundles into `folder` (shared by all executors); returns the record index, itself written."""
    def write(parts: Batches) -> Batches:
        bundle = None
        for part in parts:
            index = []
            for row, data in zip(part.drop_columns(["payload"]).to_pylist(), texts(part, "payload")):
                if bundle is None:
                    bundle = Bundle(f"{folder}/{uuid.uuid4().hex}.warc.zst")
                whole = record(row["page"], row["url"], row["kind"], row["refers"], row["digest"], row["size"], data)
                frame, offset = bundle.add(whole)
                index.append((row["page"], bundle.path, frame, offset, len(whole)))
                if bundle.total >= BUNDLE_BYTES:
                    bundle.close()
                    bundle = None
            columns = list(zip(*index)) or [[]] * 5
            kinds = [part.schema.field("page").type, pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["page", "bundle", "frame", "start", "length"])
        if bundle is not None:
            bundle.close()

    spark = pages.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(folder)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hadoop)
    rows = decided(pages, id, url, payload)
    kind = rows.schema["page"].dataType.simpleString()
    return written(rows.mapInArrow(write, f"page {kind}, bundle string, frame long, start long, length long"), "index")


def read(index: DataFrame) -> DataFrame:
    """The records that the index rows name: page, kind, refers, payload (empty for revisits), digest, size."""
    def records(parts: Batches) -> Batches:
        reader, opened = None, None
        for part in parts:
            out: list[tuple] = []
            for row in part.to_pylist():
                if row["bundle"] != opened:
                    reader, opened = Reader(row["bundle"]), row["bundle"]
                data = reader.frame(row["frame"])[row["start"] : row["start"] + row["length"]]
                out.append(_columns(*parsed(data)))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["page", "kind", "refers", "payload", "digest", "size"])

    dealt = index.repartition("bundle").sortWithinPartitions("bundle", "frame", "start")
    return dealt.mapInArrow(lambda parts: records(p for p in parts if p.num_rows), "page long, kind string, refers long, payload binary, digest string, size long")


def _columns(headers: dict[str, str], block: bytes) -> tuple:
    def page(name: str) -> int | None:
        text = headers.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        return int(text) if text else None

    digest, size = headers["WARC-Payload-Digest"].removeprefix("sha256:"), int(headers["WARC-Payload-Length"])
    if headers["WARC-Type"] == "response" and (len(block), hashlib.sha256(block).hexdigest()) != (size, digest):
        raise ValueError(f"payload of {headers['WARC-Record-ID']} doesn't match its digest")
    return page("WARC-Record-ID"), headers["WARC-Type"], page("WARC-Refers-To"), block, digest, size


def round_trip(pages: DataFrame) -> DataFrame:
    folder = scratch_folder(pages.sparkSession, "warc")
    return read(archive(pages, folder))
