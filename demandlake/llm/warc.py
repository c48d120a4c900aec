"""WARC archives written in deterministic shards, and read back.

Records are range-sorted by page into shards of about equal payload. A task writes its
shard under temporary names, starts a new file when the compressed size is reached, renames
what is complete, and reports it in a manifest, which Spark commits. Content and names
depend on the rows alone, so a task that runs twice replaces its files by the same ones, and
readers only open what the manifest lists.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake.llm.rows import Batches, in_batches
from demandlake.session import work_folder

# Payload of a shard, and compressed size at which a file ends.
SHARD_BYTES = 32 << 20
FILE_BYTES = 32 << 20
# Equal payloads of fewer bytes are stored again and not revisited.
LEAST_REVISITED = 0
DATE = "1970-01-01T00:00:00Z"

_SLICES = 4096
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_SOFTWARE = b"software: demandlake\r\nformat: WARC File Format 1.1\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "shard long, file string, records long, bytes long, sha256 string"


# ------------------------------------------------------------------- shards


def shard_bounds(sizes: DataFrame, shard_bytes: int = SHARD_BYTES) -> list[int]:
    """Largest page of each shard but the last, from ``page_id`` and ``size`` of all rows.

    Identifiers are counted in at most 4096 slices of their range at a time, and slices
    that hold more than a shard are counted anew in finer ones, down to a single
    identifier. The bounds depend on the rows alone.
    """

    def slices(low: int, high: int) -> Iterator[tuple[int, int]]:
        """Last identifier and bytes of each slice from ``low`` to ``high``, in order."""
        width = -(-(high - low + 1) // _SLICES)
        inside = sizes.where(F.col("page_id").between(low, high))
        # wide decimals: the distance of two longs may not fit in a long
        at = F.expr(f"(CAST(page_id AS DECIMAL(20, 0)) - {low}) DIV {width}")
        found = inside.groupBy(at.cast("long").alias("slice")).agg(F.sum("size").alias("size")).orderBy("slice").collect()
        for row in found:
            first = low + row["slice"] * width
            if row["size"] > shard_bytes and width > 1:
                yield from slices(first, min(high, first + width - 1))
            else:
                yield min(high, first + width - 1), row["size"]

    ends = sizes.agg(F.min("page_id").alias("low"), F.max("page_id").alias("high")).first()
    if ends["low"] is None:
        return []
    bounds, filled = [], 0
    for last, size in slices(ends["low"], ends["high"]):
        filled += size
        if filled >= shard_bytes:
            bounds.append(last)
            filled = 0
    return bounds if filled or not bounds else bounds[:-1]


# ------------------------------------------------------------------ records


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    """One record: the response with its payload, or a revisit with the response's headers only."""
    http = _HTTP.format(size).encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", url and "".join(c for c in url if c not in "\r\n")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()),
        ("WARC-Profile", _PROFILE if refers_to is not None else None),
        ("WARC-Refers-To", record_id(refers_to, digest) if refers_to is not None else None),
        ("X-Page-ID", page_id),
        ("X-Refers-To-Page-ID", refers_to),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", len(block)),
    ]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _packed(data: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


class _Files:
    """The files of one shard, under temporary names until they are complete."""

    def __init__(self, folder: str, shard: int, file_bytes: int) -> None:
        self._store, self._folder = fs.FileSystem.from_uri(folder)
        self._shard, self._limit, self._number = shard, file_bytes, 0
        self._stream = None

    def add(self, data: bytes) -> dict | None:
        """Append a record; the manifest row of the file that it filled."""
        if self._stream is None:
            self._name = f"shard-{self._shard:08d}-{self._number:06d}.warc.gz"
            self._temporary = f"{self._folder}/_temporary/{self._name}.{uuid.uuid4().hex}"
            self._stream = self._store.open_output_stream(self._temporary, compression=None)
            self._records = self._bytes = 0
            self._sum = hashlib.sha256()
            head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid5(_NAMES, self._name)}>\r\nWARC-Date: {DATE}\r\nWARC-Filename: {self._name}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(_SOFTWARE)}\r\n\r\n"
            self._put(_packed(head.encode() + _SOFTWARE + b"\r\n\r\n"))
        self._put(_packed(data))
        self._records += 1
        return self.close() if self._bytes >= self._limit else None

    def _put(self, data: bytes) -> None:
        self._stream.write(data)
        self._sum.update(data)
        self._bytes += len(data)

    def close(self) -> dict | None:
        if self._stream is None:
            return None
        self._stream.close()
        self._stream = None
        self._store.move(self._temporary, f"{self._folder}/{self._name}")
        self._number += 1
        return dict(shard=self._shard, file=self._name, records=self._records, bytes=self._bytes, sha256=self._sum.hexdigest())


def write_archives(
    pages: DataFrame,
    folder: str,
    shard_bytes: int = SHARD_BYTES,
    file_bytes: int = FILE_BYTES,
    least_revisited: int = LEAST_REVISITED,
) -> DataFrame:
    """Write a record for each row of ``pages`` (``page_id``, ``url``, ``html``); returns the manifest.

    The payload is ``html`` in UTF-8, empty for a null. Of equal payloads of
    ``least_revisited`` bytes or more, those of the largest page are responses and the
    others revisit it. A null page sorts first and is never revisited; a null url leaves its
    header out. Rows that repeat one page and payload are written as often. An empty
    table writes no file, and its manifest has no rows.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    page = F.col("page_id").cast("long")
    narrow = pages.select(page.alias("page_id"), F.sha1(payload).alias("digest"), F.length(payload).cast("long").alias("size"))
    bounds = shard_bounds(narrow.select("page_id", "size"), shard_bytes)
    copies = (
        narrow.where(F.col("size") >= least_revisited)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("many"))
        .where((F.col("many") > 1) & F.col("refers_to").isNotNull())
        .drop("many")
    )
    revisits = narrow.join(copies, ["digest", "size"]).where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    marks = revisits.select("page_id", "digest", "size", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "refers_to")
    rows = pages.select(
        page.alias("page_id"),
        F.sha1(payload).alias("digest"),
        F.length(payload).cast("long").alias("size"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.lit(None).cast("long").alias("refers_to"),
    )
    spread = F.lit(0).cast("int")
    if bounds:
        known = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
        spread = F.coalesce(F.size(F.filter(known, lambda bound: bound < F.col("page_id"))), F.lit(0))
    placed = (
        rows.unionByName(marks)
        .withColumn("shard", spread)
        .repartitionById(len(bounds) + 1, "shard")
        .sortWithinPartitions("shard", "page_id", "digest", F.col("refers_to").desc(), "url")
    )
    store, path = fs.FileSystem.from_uri(f"{folder}/data")
    store.create_dir(f"{path}/_temporary", recursive=True)

    def run(batches: Batches) -> Batches:
        files, mark = None, None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if files is None or files._shard != row["shard"]:
                    done.append(files.close() if files else None)
                    files, mark = _Files(f"{folder}/data", row["shard"], file_bytes), None
                if row["payload"] is None:
                    mark = (row["page_id"], row["digest"], row["refers_to"])
                    continue
                refers_to = mark[2] if mark and mark[:2] == (row["page_id"], row["digest"]) else None
                digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
                done.append(files.add(record(row["page_id"], row["url"], row["payload"], digest, row["size"], refers_to)))
            yield _listed(done)
        if files is not None:
            yield _listed([files.close()])

    in_batches(placed, run, _MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")


def _listed(done: list[dict | None]) -> pa.RecordBatch:
    kinds = [("shard", pa.int64()), ("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())]
    return pa.RecordBatch.from_pylist([d for d in done if d], schema=pa.schema(kinds))


# ------------------------------------------------------------------ reading


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    unpack, parts, data = zlib.decompressobj(31), [], stream.read(chunk)
    while data:
        parts.append(unpack.decompress(data))
        if unpack.eof:
            yield b"".join(parts)
            data, unpack, parts = unpack.unused_data or stream.read(chunk), zlib.decompressobj(31), []
        else:
            data = stream.read(chunk)
    if any(parts):
        raise ValueError("the archive ends inside a record")


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    return fields, rest[: int(fields["Content-Length"])]


def read_archives(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """The records of all files that the manifest lists, each checked against its digests.

    ``page_id``, ``url``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``,
    and with ``payloads`` the payload (null for a revisit).
    """
    listed = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest").select("file")

    def run(batches: Batches) -> Batches:
        store, path = fs.FileSystem.from_uri(f"{folder}/data")
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *["payload"] * payloads]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), *[pa.binary()] * payloads]
        schema = pa.schema(list(zip(names, kinds, strict=True)))
        for batch in batches:
            for name in batch.column("file").to_pylist():
                held, size = [], 0
                with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for raw in members(stream):
                        fields, block = parsed(raw)
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        held.append(_read(fields, block, payloads))
                        size += len(raw) if payloads else 256
                        if size > 16 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema=schema)
                            held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema=schema)

    fields = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return in_batches(listed.repartition(max(1, listed.count())), run, fields + ", payload binary" * payloads)


def _read(fields: dict[str, str], block: bytes, payloads: bool) -> dict:
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["WARC-Type"] == "revisit"
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"payload digest of {fields['WARC-Record-ID']} differs")
    row = dict(
        page_id=int(fields["X-Page-ID"]) if "X-Page-ID" in fields else None,
        url=fields.get("WARC-Target-URI"),
        payload_bytes=size,
        payload_digest=digest,
        record_type=fields["WARC-Type"],
        refers_to=int(fields["X-Refers-To-Page-ID"]) if revisit else None,
    )
    return row | ({"payload": None if revisit else payload} if payloads else {})


def archived(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back."""
    folder = work_folder(pages.sparkSession, "warc")
    write_archives(pages, folder)
    return read_archives(pages.sparkSession, folder)
