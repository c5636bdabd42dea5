"""Deterministic sharded WARC archives.

Records are sorted by id and payload digest and dealt to shards, ranges of these with about
equal bytes. A task writes a shard's records, each a gzip member, and starts a new file
when the compressed size passes the limit. Headers and digests come from the
record alone, so a shard has the same bytes in every run. A file is written under
a temporary name and renamed when complete: a repeated or doubled task puts the
same file in place. The manifest lists files, sizes and digests; it is written by
Spark after all shards, and readers take only what it lists.

Of records with equal payloads of at least ``revisit_bytes``, that with the
smallest id is the response and the others revisit it. Defined cases: a null
payload is empty; a null id is larger than all others and has no id header;
repeated rows of the smallest id are all responses; control characters and
spaces in URLs are percent-encoded, a null URL is left out.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltbed.llm.common import id_order, mapped, stored
from siltbed.operators import small_side
from siltbed.scratch import scratch_dir

#: So many shards at most; beyond, each is larger.
MAX_SHARDS = 1 << 16
#: Taken for the headers of a record.
HEAD_BYTES = 500
_NO_ID = (1 << 63) - 1


@dataclass(frozen=True)
class WarcParameters:
    revisit_bytes: int = 100
    #: A file is closed when its compressed size has reached this.
    file_bytes: int = 8 << 20
    #: Payload and header bytes of a shard.
    shard_bytes: int = 16 << 20
    level: int = 3
    date: str = "2000-01-01T00:00:00Z"


def _payload() -> Column:
    return F.encode(F.coalesce("html", F.lit("")), "UTF-8")


def _digest(payload: Column) -> Column:
    return F.unhex(F.sha2(payload, 256))


def keys_of(pages: DataFrame) -> DataFrame:
    """One row for each id and payload: id, digest, payload_bytes, weight (archive bytes before compression), area.

    Areas are ranges of (id, digest), in order; they only spread the prefix sums.
    """
    payload = _payload()
    keys = (
        pages.select(id_order("page_id").alias("id"), _digest(payload).alias("digest"), F.length(payload).cast("long").alias("payload_bytes"))
        .groupBy("id", "digest", "payload_bytes")
        .agg((F.count("*") * (F.col("payload_bytes") + HEAD_BYTES)).alias("weight"))
    )
    return stored(keys.repartitionByRange("id", "digest").withColumn("area", F.spark_partition_id()), "warc-keys")


def revisits(keys: DataFrame, p: WarcParameters) -> DataFrame:
    """id, digest and first: the id of the response that each revisit refers to."""
    long_enough = keys.where(F.col("payload_bytes") >= p.revisit_bytes)
    repeated = (
        long_enough.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").drop("last")
    )
    return long_enough.join(small_side(repeated), "digest").where("id > first").select("id", "digest", "first")


def _ordered(ids: np.ndarray, digests: list[bytes]) -> np.ndarray:
    """Byte strings in the order of (id, digest)."""
    out = np.empty((len(ids), 40), dtype=np.uint8)
    biased = (ids.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8")
    out[:, :8] = biased.view(np.uint8).reshape(-1, 8)
    out[:, 8:] = np.frombuffer(b"".join(digests), dtype=np.uint8).reshape(-1, 32)
    return out.view("S40").ravel()


def shard_bounds(keys: DataFrame, p: WarcParameters) -> np.ndarray:
    """First (id, digest) of each shard, in order.

    A shard has about ``shard_bytes`` of all bytes before compression, more where
    there would be over MAX_SHARDS. Bounds follow from prefix sums in the order of
    (id, digest), so clustered, far and null ids are divided like any others. Rows of one
    id and one payload stay together.
    """
    areas = {r["area"]: r["weight"] for r in keys.groupBy("area").agg(F.sum("weight").alias("weight")).collect()}  # a row per task
    total = sum(areas.values())
    size = max(p.shard_bytes, -(-total // MAX_SHARDS))
    before, at = [], 0
    for area in sorted(areas):
        before.append((area, at))
        at += areas[area]
    if not before:
        return np.zeros(0, dtype="S40")
    offsets = keys.sparkSession.createDataFrame(before, "area int, before bigint")
    within = Window.partitionBy("area").orderBy("id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("weight").over(within), F.lit(0)) + F.col("before")
    firsts = (
        keys.join(F.broadcast(offsets), "area")
        .select("id", "digest", F.floor(start / F.lit(size)).alias("shard"))
        .groupBy("shard")
        .agg(F.min(F.struct("id", "digest")).alias("k"))
        .orderBy("shard")
        .select("k.*")
        .collect()  # at most MAX_SHARDS rows
    )
    return _ordered(np.array([r["id"] for r in firsts], dtype=np.int64), [bytes(r["digest"]) for r in firsts])


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{digest}')}>"


def _url(text: str) -> str:
    return "".join(f"%{b:02X}" if b <= 0x20 or b >= 0x7F else chr(b) for b in text.encode())


def record(page_id: int, url: str | None, payload: bytes, digest: str, first: int | None, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if first is None else http
    own = None if page_id == _NO_ID else page_id
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(own, digest)}",
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"X-Payload-Length: {len(payload)}",
        f"Content-Length: {len(block)}",
    ]
    if own is not None:
        head.append(f"X-Page-ID: {own}")
    if url is not None:
        head.append(f"WARC-Target-URI: {_url(url)}")
    if first is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {record_id(first, digest)}")
        head.append(f"X-Refers-To-Page-ID: {first}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _File:
    """One archive file under a temporary name until it is closed."""

    def __init__(self, store: fs.FileSystem, folder: str, name: str):
        self.store, self.name = store, name
        self.path, self.temporary = f"{folder}/{name}", f"{folder}/.{name}.{uuid.uuid4().hex}"
        self.out = store.open_output_stream(self.temporary, compression=None)
        self.bytes, self.records, self.digest = 0, 0, hashlib.sha256()

    def add(self, data: bytes) -> None:
        self.out.write(data)
        self.digest.update(data)
        self.bytes, self.records = self.bytes + len(data), self.records + 1

    def close(self) -> tuple[str, int, int, str]:
        self.out.close()
        self.store.move(self.temporary, self.path)
        return self.name, self.bytes, self.records, self.digest.hexdigest()


def write(pages: DataFrame, folder: str, p: WarcParameters = WarcParameters()) -> DataFrame:
    """Write page_id, url, html rows as archives under ``folder``, which all executors share; returns the manifest."""
    keys = keys_of(pages)
    bounds = shard_bounds(keys, p)
    n_shards = max(1, len(bounds))

    @F.pandas_udf("int")
    def shard(ids, digests):
        import pandas as pd

        at = np.searchsorted(bounds, _ordered(ids.to_numpy(), list(digests)), side="right") - 1
        return pd.Series(at.astype(np.int32))

    date, level, limit = p.date, p.level, p.file_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        done, now, at, part, revisit = [], None, None, 0, (None, None, None)
        for batch in batches:
            columns = [batch.column(c) for c in ("shard", "id", "url", "payload", "digest", "first")]
            for values in zip(*columns, strict=True):
                shard_, page_id, url, payload, digest, first = (v.as_py() for v in values)
                if first is not None:
                    # Not a record: it says what the records of its id and payload, which follow, refer to.
                    revisit = (page_id, digest, first)
                    continue
                first = revisit[2] if revisit[:2] == (page_id, digest) else None
                if now is not None and (shard_ != at or now.bytes >= limit):
                    done.append((at, *now.close()))
                    part, now = (part + 1 if shard_ == at else 0), None
                if now is None:
                    at, now = shard_, _File(store, root, f"shard-{shard_:08d}-{part:05d}.warc.gz")
                now.add(_member(record(page_id, url, payload, digest.hex(), first, date), level))
        if now is not None:
            done.append((at, *now.close()))
        names = ["shard", "name", "bytes", "records", "sha256"]
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate(kinds)], names)

    # The payload moves once: revisits are told to a shard by rows among its records, not by a join with them.
    payload = _payload()
    records = pages.select(
        id_order("page_id").alias("id"), "url", payload.alias("payload"), _digest(payload).alias("digest"), F.lit(None).cast("bigint").alias("first")
    )
    rows = records.unionByName(revisits(keys, p), allowMissingColumns=True)
    placed = (
        rows.withColumn("shard", shard("id", "digest"))
        .repartitionById(n_shards, F.col("shard"))
        .sortWithinPartitions("shard", "id", "digest", F.desc_nulls_last("first"), "url")
    )
    written = placed.select("shard", "id", "url", "payload", "digest", "first").transform(
        mapped, run, "shard int, name string, bytes bigint, records bigint, sha256 string"
    )
    written.write.parquet(f"{folder}/manifest")
    return manifest(pages.sparkSession, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("shard int, name string, bytes bigint, records bigint, sha256 string").parquet(f"{folder}/manifest")


def members(data: bytes) -> Iterator[bytes]:
    """Contents of the gzip members of a file."""
    view, at, step = memoryview(data), 0, 1 << 16
    while at < len(view):
        out, unpacker = [], zlib.decompressobj(31)
        while not unpacker.eof:
            if at >= len(view):
                raise ValueError("archive ends within a record")
            out.append(unpacker.decompress(view[at : at + step]))
            at += min(step, len(view) - at) - len(unpacker.unused_data)
        yield b"".join(out)


def parse(data: bytes) -> dict:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if hashlib.sha256(block).hexdigest() != fields["WARC-Block-Digest"].removeprefix("sha256:"):
        raise ValueError(f"block digest of {fields['WARC-Record-ID']} does not hold")
    payload = block.partition(b"\r\n\r\n")[2]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"payload digest of {fields['WARC-Record-ID']} does not hold")
    number = lambda key: int(fields[key]) if key in fields else None
    return {
        "page_id": number("X-Page-ID"),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": number("X-Payload-Length"),
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number("X-Refers-To-Page-ID"),
        "payload": payload if kind == "response" else None,
    }


_RECORD = {
    "page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
    "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary(),
}


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the committed files: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload."""
    kinds = {k: v for k, v in _RECORD.items() if payloads or k != "payload"}
    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.warc.gz").load(folder)
    listed = manifest(spark, folder).select("name", "sha256")
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content").join(small_side(listed), "name")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, digest in zip(batch.column("content"), batch.column("sha256"), strict=True):
                data = content.as_py()
                if hashlib.sha256(data).hexdigest() != digest.as_py():
                    raise ValueError("an archive file differs from its manifest")
                rows: list[dict] = []
                for item in members(data):
                    rows.append(parse(item))
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in kinds.items()], list(kinds))
                        rows = []
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in kinds.items()], list(kinds))

    schema = ", ".join(f"{k} {'bigint' if v == pa.int64() else 'string' if v == pa.string() else 'binary'}" for k, v in kinds.items())
    return named.select("content", "sha256").transform(mapped, run, schema)


def round_trip(pages: DataFrame, p: WarcParameters = WarcParameters()) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, read back from archives."""
    spark = pages.sparkSession
    folder = scratch_dir(spark, "warc")
    write(pages, folder, p)
    return read(spark, folder, payloads=False)
