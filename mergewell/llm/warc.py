"""WARC archives: a deterministic sharded writer with manifests, and a reader."""

from __future__ import annotations

import bisect
import gzip
import hashlib
import re
import uuid
import zlib

import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, functions as F, types as T

from mergewell.llm.rows import SLICE
from mergewell.llm.scratch import Scratch

SMALLEST = 100  # bytes of a payload that may be replaced by a reference
SHARD_BYTES = 32 << 20  # payload that one shard holds on average
MOST_SHARDS = 20_000  # bounds the split points that the driver and every task hold
SAMPLES = 16  # ids looked at for each split point
ROLL_BYTES = 16 << 20  # compressed size at which a file ends
DATE = "2024-01-01T00:00:00Z"  # the table has no dates; a fixed one keeps reruns equal
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed by WARC 1.1


def payloads(df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, payload, digest): UTF-8 of the html, empty for a missing one."""
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    return df.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
                     payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))


def references(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """(page_id, digest, refers_to) of the records that revisit a smaller page."""
    known = scratch.write(pages.filter(F.octet_length("payload") >= SMALLEST).select("page_id", "digest"), "ids")
    first = scratch.write(known.groupBy("digest").agg(
        F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "first")
    return scratch.write(known.join(first, "digest").filter(
        "refers_to is not null and not (page_id <=> refers_to)").distinct().select(
        "page_id", "digest", "refers_to"), "references")


def split_points(pages: DataFrame) -> list[tuple[int, str]]:
    """Ends of the shards: (page_id, digest) pairs from a sample chosen by hash, so that the
    same table always gives the same shards, and a page_id of many rows can be split."""
    n, total = pages.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("payload")), F.lit(0))).first()
    shards = min(MOST_SHARDS, -(-total // SHARD_BYTES))
    if shards < 2:
        return []
    every = max(1, n // (SAMPLES * shards))
    sample = pages.filter(F.pmod(F.xxhash64("page_id", "digest"), F.lit(every)) == 0)
    keys = sorted({_key(*row) for row in sample.select("page_id", "digest").collect()})
    return sorted({keys[len(keys) * k // shards] for k in range(1, shards)}) if keys else []


def _key(page_id, digest):
    return (-1 << 63 if page_id is None else page_id, digest)


_MANIFEST = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("temporary", T.StringType()),
    T.StructField("shard", T.LongType()), T.StructField("records", T.LongType()),
    T.StructField("bytes", T.LongType()), T.StructField("sha256", T.StringType())])


def _manifest(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=_MANIFEST.names)


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record; a revisit (refers_to) holds the HTTP head alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("WARC-Profile", PROFILE if refers_to is not None else None),
        ("WARC-Refers-To", record_id(refers_to, digest) if refers_to is not None else None),
        ("Page-Id", page_id), ("Refers-To-Page-Id", refers_to),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block))]
    lines = "".join(f"{name}: {value}\r\n" for name, value in head if value is not None)
    return b"WARC/1.1\r\n" + lines.encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{digest}')}>"


class _Shard:
    """Files of one shard; each ends with the record that takes it over ROLL_BYTES."""

    def __init__(self, folder: str, shard: int):
        self.store, self.base = pyarrow.fs.FileSystem.from_uri(folder)
        self.shard, self.number, self.file = shard, 0, None

    def add(self, data: bytes):
        if self.file is None:
            self.temporary = f"_temporary/{uuid.uuid4().hex}.warc.gz"
            self.store.create_dir(f"{self.base}/_temporary", recursive=True)
            self.file = self.store.open_output_stream(f"{self.base}/{self.temporary}", compression=None)
            self.records, self.bytes, self.digest = 0, 0, hashlib.sha256()
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)  # a gzip member without time or name
        member = packer.compress(data) + packer.flush()
        self.file.write(member)
        self.digest.update(member)
        self.records, self.bytes = self.records + 1, self.bytes + len(member)
        return [self.close()] if self.bytes >= ROLL_BYTES else []

    def close(self) -> tuple:
        self.file.close()
        line = (f"part-{self.shard:06d}-{self.number:04d}.warc.gz", self.temporary, self.shard,
                self.records, self.bytes, self.digest.hexdigest())
        self.file, self.number = None, self.number + 1
        return line


def write_archives(pages: DataFrame, folder: str, scratch: Scratch) -> DataFrame:
    """Write pages (page_id, url, payload, digest) as archives below folder; returns the
    manifest (name, temporary, shard, records, bytes, sha256), which is also written there.

    Records are range-sorted by page_id, then digest; reruns on the same rows write the same
    bytes.  Tasks write under temporary names that no other attempt shares; the manifest names
    those of the attempts that count, and only they are renamed.  Payloads are shuffled once;
    a revisit's reference travels as a small row that sorts before its record.
    A missing page_id sorts first; with no rows there are no files and an empty manifest.  Repeated
    rows are records each; a very long page is a record of its own in a file that ends with it.
    """
    spark = pages.sparkSession
    refers = references(pages, scratch)
    points = spark.sparkContext.broadcast(split_points(pages))
    rows = pages.withColumn("kind", F.lit(1)).withColumn("refers_to", F.lit(None).cast("long")).unionByName(
        refers.withColumn("kind", F.lit(0)), allowMissingColumns=True)

    @F.pandas_udf("long")
    def shard_of(ids: pd.Series, digests: pd.Series) -> pd.Series:
        ends = points.value
        return pd.Series([bisect.bisect_right(ends, key) for key in zip(ids, digests)], dtype="int64")

    present = F.coalesce("page_id", F.lit(-1 << 63))
    # One task per shard: hashed or ranged again, several shards would meet in one task.
    ordered = rows.withColumn("shard", shard_of(present, F.col("digest"))).repartitionById(
        len(points.value) + 1, F.col("shard").cast("int")).sortWithinPartitions("shard", "page_id", "digest", "kind", "url").select(
        "shard", "page_id", "digest", "kind", "refers_to", "url", "payload")

    def work(batches):
        writer, reference = None, None
        for whole in batches:
            for first in range(0, whole.num_rows, SLICE // 8):
                out = []
                batch = whole.slice(first, SLICE // 8)
                for shard, page_id, digest, kind, refers_to, url, payload in zip(
                        *[c.to_pylist() for c in batch.columns]):
                    if writer is None or writer.shard != shard:
                        if writer is not None and writer.file is not None:
                            out.append(writer.close())
                        writer = _Shard(folder, shard)
                    if kind == 0:
                        reference = (page_id, digest, refers_to)
                        continue
                    to = reference[2] if reference and reference[:2] == (page_id, digest) else None
                    out += writer.add(record(page_id, url, payload, digest, to))
                if out:
                    yield _manifest(out)
        if writer is not None and writer.file is not None:
            yield _manifest([writer.close()])

    pending = scratch.write(ordered.mapInArrow(work, _MANIFEST), "pending")

    def commit(batches):
        store, base = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, temporary in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                source, target = f"{base}/{temporary}", f"{base}/{name}"
                if store.get_file_info(source).type != pyarrow.fs.FileType.NotFound:
                    store.move(source, target)  # else an earlier attempt of this task moved it
            yield batch

    pending.mapInArrow(commit, _MANIFEST).write.mode("overwrite").parquet(f"{folder}/_manifest")
    scratch.delete(f"{folder}/_temporary")
    return spark.read.schema(_MANIFEST).parquet(f"{folder}/_manifest")


_RECORD = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("refers_to", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("intact", T.BooleanType())])


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """One line per record of the archives in the manifest: page_id, payload_bytes,
    payload_digest, record_type, refers_to, url and intact (all digests agree).

    A revisit's length and digest are those in its heads, as its payload is elsewhere."""

    def work(batches):
        store, base = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_stream(f"{base}/{name}", compression=None) as raw, \
                        gzip.GzipFile(fileobj=raw) as file:
                    rows = []
                    while (row := _read(file)) is not None:
                        rows.append(row)
                        if len(rows) == SLICE:
                            yield _records(rows)
                            rows = []
                    if rows:
                        yield _records(rows)

    files = manifest.select("name")
    return files.repartition(max(1, files.count())).mapInArrow(work, _RECORD)


def _records(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=_RECORD.names)


def _head(lines) -> dict[str, str]:
    out = {}
    for line in lines:
        name, _, value = line.decode("utf-8", "surrogatepass").rstrip("\r\n").partition(": ")
        out[name] = value
    return out


def _read(file) -> tuple | None:
    version = file.readline()
    if not version:
        return None
    if version != b"WARC/1.1\r\n":
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    head = _head(iter(file.readline, b"\r\n"))
    block = file.read(int(head["Content-Length"]))
    if file.read(4) != b"\r\n\r\n":
        raise ValueError("a record does not end where it should")
    cut = block.index(b"\r\n\r\n") + 4
    http = _head(block[:cut - 4].split(b"\r\n")[1:])
    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
    intact = head["WARC-Block-Digest"] == f"sha256:{hashlib.sha256(block).hexdigest()}"
    size = int(http["Content-Length"])
    if head["WARC-Type"] == "response":
        read = hashlib.sha256(block[cut:]).hexdigest()
        intact = intact and read == digest and size == len(block) - cut
        digest, size = read, len(block) - cut
    number = lambda name: int(head[name]) if name in head else None
    return (number("Page-Id"), size, digest, head["WARC-Type"], number("Refers-To-Page-Id"),
            head.get("WARC-Target-URI"), intact)
