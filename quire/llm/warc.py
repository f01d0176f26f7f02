"""Deterministic sharded WARC writer and its reader.

Records are cut into key ranges (splitters from a hash sample weighted by size), sorted by
key inside each range, and written as one gzip member each; a file is rolled when its
compressed size passes a limit.  Headers and digests are generated anew from the record
alone (the date is a parameter), so the same rows always give the same bytes.  Tasks write
under temporary names and return manifest rows; files that the manifest names are then
renamed, the manifest is put in place last, and a reader opens only files that it names.

Of records with equal payloads of at least ``revisit_from`` bytes the one with the largest
key is a response and the others are revisits of it.

Defined cases: a null payload is empty; a null url becomes ``urn:key:<key>``; a null key
sorts first and is written as an empty key; repeated rows with one key and payload give one
response and revisits that refer to it; an empty input gives a manifest without files;
payloads of any length are written whole.  Columns other than those named are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import scratch, table, written
from quire.operators.joins import lookup_join

DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ROLL_BYTES = 64 << 20       # compressed bytes after which a file is closed
SHARD_BYTES = 32 << 20      # payload bytes in a range, about
LEAST_SHARDS, MOST_SHARDS = 48, 100_000
HOT_ROWS = 1_000            # rows of one payload from which its join is split off, at least
SAMPLE = 20_000             # keys sampled for the splitters, about
MANIFEST = "shard int, part int, temporary string, name string, records long, size long, sha256 string"
RECORD = ("key long, url string, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long, payload binary")


def open_folder(path: str):
    """(file system, folder) of a path that driver and executors share."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:/") else f"file://{path}")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(key: str, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'record:{key}:{digest}:{copy}')}>"


def _header(value: str) -> str:
    """A header value on one line: white space and controls are percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(key: str, url: str | None, payload: bytes, digest: str, refers_to: str | None, copy: int,
           date: str = DATE) -> bytes:
    """The bytes of one record, not yet compressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: {record_id(key, digest, copy)}", f"WARC-Date: {date}",
             f"WARC-Target-URI: {_header(url) if url else f'urn:key:{key}'}",
             "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}",
             f"WARC-Block-Digest: sha1:{base32_sha1(block)}", f"X-Key: {key}"]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest, 0)}",
                  f"X-Refers-To-Key: {refers_to}"]
    lines += [f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def gzipped(data: bytes) -> bytes:
    """One gzip member without a time stamp."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Files:
    """The files of one task: opened under temporary names, rolled by compressed size."""

    def __init__(self, folder: str, run: str, roll: int):
        task = TaskContext.get()
        self.attempt = f"{task.partitionId()}-{task.taskAttemptId()}" if task else "0-0"
        self.store, self.folder = open_folder(folder)
        self.temporary, self.roll, self.out, self.done = f"_temporary/{run}", roll, None, []
        self.shard, self.part = None, 0

    def add(self, shard: int, data: bytes) -> None:
        if self.out is None or shard != self.shard or self.size >= self.roll:
            self.close()
            self.shard, self.part = shard, self.part + 1 if shard == self.shard else 0
            self.name = f"shard-{shard:05d}-{self.part:05d}.warc.gz"
            self.path = f"{self.temporary}/{self.attempt}-{self.name}"
            self.store.create_dir(f"{self.folder}/{self.temporary}")
            self.out = self.store.open_output_stream(f"{self.folder}/{self.path}")
            self.size, self.records, self.sha = 0, 0, hashlib.sha256()
        data = gzipped(data)
        self.out.write(data)
        self.sha.update(data)
        self.size, self.records = self.size + len(data), self.records + 1

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.shard, self.part, self.path, self.name, self.records, self.size, self.sha.hexdigest()))
            self.out = None

    def rows(self) -> pa.RecordBatch:
        self.close()
        done, self.done = self.done, []
        names = [c.split()[0] for c in MANIFEST.split(", ")]
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate(kinds)], names)


def _splitters(rows: DataFrame) -> np.ndarray:
    """Splitters of the key ranges: quantiles of keys drawn, by hash, in proportion to size."""
    total = rows.agg(F.sum("payload_bytes")).first()[0]
    shards = int(min(max((total or 0) // SHARD_BYTES, LEAST_SHARDS), MOST_SHARDS))
    chance = SAMPLE / max(total or 0, 1)
    unit = (F.xxhash64("key", "digest") / F.lit(2.0 ** 64)) + 0.5
    drawn = rows.where(unit < F.col("payload_bytes") * chance).select("key").dropna().limit(4 * SAMPLE)
    keys = np.sort(np.array([r[0] for r in drawn.collect()], np.int64))
    return np.unique(keys[(np.arange(1, shards) * len(keys)) // shards]) if len(keys) else keys


def write_warc(df: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html",
               revisit_from: int = 0, roll: int = ROLL_BYTES, date: str = DATE) -> DataFrame:
    """Write one record per row under ``folder`` and return the manifest; ``date`` is that of all records (a
    fixed one unless given, so that the same rows make the same files).

    Payloads are shuffled once: each revisit's target travels as a narrow row of its own that
    sorts just before its record."""
    spark, run = df.sparkSession, uuid.uuid4().hex[:12]
    data = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    wide = df.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), data.alias("payload"),
                     F.sha2(data, 256).alias("digest"))
    narrow = written(wide.select("key", "digest", F.length("payload").cast("long").alias("payload_bytes")), "payloads")
    groups = narrow.where(F.col("payload_bytes") >= revisit_from).groupBy("digest") \
        .agg(F.max("key").alias("target"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    # The target itself gets such a row too: repeated rows of it are revisits of the first.
    targets = lookup_join(narrow, groups, "digest", min_rows=HOT_ROWS).select("key", F.lit(None).cast("string").alias("url"),
                                                   F.lit(None).cast("binary").alias("payload"), "digest",
                                                   "target", F.lit(0).alias("kind")).distinct()
    splitters = _splitters(narrow)

    @F.arrow_udf("int")
    def shard_of(keys: pa.Array) -> pa.Array:
        at = np.searchsorted(splitters, keys.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False), side="right")
        return pa.array(at, pa.int32())

    both = targets.unionByName(wide.withColumns({"target": F.lit(None).cast("long"), "kind": F.lit(1)}))
    dealt = both.withColumn("shard", shard_of("key")).repartition(len(splitters) + 1, "shard") \
        .sortWithinPartitions("shard", "key", "digest", "kind")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, last, target, copies = Files(folder, run, roll), None, None, 0
        for batch in batches:
            for k in range(batch.num_rows):
                shard, key_, digest, kind = (batch[c][k].as_py() for c in ("shard", "key", "digest", "kind"))
                if (key_, digest) != last:
                    last, target, copies, grouped = (key_, digest), None, 0, False
                if kind == 0:
                    target, grouped = batch["target"][k].as_py(), True
                    continue
                body, name = batch["payload"][k].as_py(), "" if key_ is None else str(key_)
                refers = None
                if grouped and (target != key_ or copies):
                    refers = "" if target is None else str(target)
                files.add(shard, record(name, batch["url"][k].as_py(), body, base32_sha1(body), refers, copies, date))
                copies += 1
        yield files.rows()

    made = written(dealt.mapInArrow(write, MANIFEST), "manifest")
    return commit(made, folder, run)


def commit(made: DataFrame, folder: str, run: str) -> DataFrame:
    """Give the named files their final names, put the manifest in place, drop what is left
    of lost attempts.  Renaming again after a lost task finds the final name and goes on."""
    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_folder(folder)
        for batch in batches:
            for old, new in zip(batch["temporary"].to_pylist(), batch["name"].to_pylist()):
                if store.get_file_info(f"{root}/{old}").type == fs.FileType.File:
                    store.move(f"{root}/{old}", f"{root}/{new}")
                elif store.get_file_info(f"{root}/{new}").type != fs.FileType.File:
                    raise FileNotFoundError(new)
            yield batch

    store, root = open_folder(folder)
    store.create_dir(root, recursive=True)
    moved = made.mapInArrow(rename, made.schema).drop("temporary")
    moved.write.parquet(f"{folder}/_temporary/{run}/manifest")
    store.move(f"{root}/_temporary/{run}/manifest", f"{root}/manifest")
    store.delete_dir(f"{root}/_temporary/{run}")
    return made.sparkSession.read.schema(moved.schema).parquet(f"{folder}/manifest")


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return {p[0].lower(): p[1] for p in pairs if len(p) == 2}


def members(stream, chunk: int = 1 << 20, step: int = 1 << 14) -> Iterator[bytes]:
    """The gzip members of a stream, one record each.  What follows a member is copied by the library; it gets
    ``step`` bytes at a time, so that small records do not copy a chunk each."""
    unpack, parts = zlib.decompressobj(31), []
    while data := stream.read(chunk):
        at = 0
        while at < len(data):
            piece = data[at:at + step]
            parts.append(unpack.decompress(piece))
            at += len(piece) - len(unpack.unused_data)
            if unpack.eof:
                yield b"".join(parts)
                unpack, parts = zlib.decompressobj(31), []
    if parts:
        raise ValueError("the archive ends within a record")


def parse(data: bytes) -> tuple:
    """A row of RECORD; digests are checked against what was written."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[:int(fields["content-length"])]
    if fields["warc-block-digest"] != "sha1:" + base32_sha1(block):
        raise ValueError(f"damaged record {fields['warc-record-id']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    digest, size = fields["warc-payload-digest"].removeprefix("sha1:"), int(_fields(http)["content-length"])
    kind = fields["warc-type"]
    if kind == "response" and (digest != base32_sha1(payload) or size != len(payload)):
        raise ValueError(f"damaged payload of {fields['warc-record-id']}")
    refers = fields.get("x-refers-to-key")
    return (int(fields["x-key"]) if fields.get("x-key") else None, fields["warc-target-uri"], size, digest, kind,
            int(refers) if refers else None, payload if kind == "response" else None)


def read_warc(manifest: DataFrame, folder: str) -> DataFrame:
    """The records (RECORD) of all files that a manifest names, one task's files at a time."""
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [c.split()[0] for c in RECORD.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_folder(folder)
        for batch in batches:
            for name in batch["name"].to_pylist():
                rows, size = [], 0
                with store.open_input_stream(f"{root}/{name}") as stream:
                    for data in members(stream):
                        rows.append(parse(data))
                        size += len(data)
                        if size >= 8 << 20:
                            yield batch_of(rows)
                            rows, size = [], 0
                yield batch_of(rows)

    files = manifest.select("name")
    return files.repartition(max(files.count(), 1), "name").mapInArrow(read, RECORD)


def op9_warc(spark, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    manifest = write_warc(table(spark, sf_dir, "pages"), folder)
    return read_warc(manifest, folder).select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest",
                                              "record_type", "refers_to")


#: The same from the table alone: base32 spelled out from the hexadecimal SHA-1.
OP9_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(encode(coalesce(html, ''))) AS hex,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top
  FROM pages),
d AS (
  SELECT *, list_transform(generate_series(0, 7), lambda i: CAST('0x' || substr(hex, CAST(5 * i + 1 AS INT), 5) AS INT)) AS v
  FROM p)
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(v, lambda x:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x >> 15) + 1, 1) ||
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> 10) & 31) + 1, 1) ||
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> 5) & 31) + 1, 1) ||
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM d
"""
