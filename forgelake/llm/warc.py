"""Deterministic sharded WARC writer and its reader.

Records are split by ranges of their key whose bounds come from a histogram of the key
weighted by payload bytes, so the same rows give the same shards whatever the cluster does.
A key that is heavier than a shard, and null keys, are spread over several by their
digests. Within a shard they are sorted and written as one gzip member each; a file that has reached
``file_bytes`` compressed bytes is closed and the next one begun. Headers and digests are
regenerated from the row. Of equal payloads only the record with the largest key is a
response, the others are revisits of it.

Commit: every task attempt writes under a temporary name of its own and reports its files in
a staged manifest, which Spark commits once per task. A second job renames the reported
files, and the manifest written last makes the archive visible; files of lost attempts are
in no manifest and go with the temporary folder.

The folder may be any URI that pyarrow's filesystems open on the executors (file, hdfs, s3,
gs). Files stream through bounded buffers on the way out and back.

Defined cases. A null payload is empty. A null key stands in the first shards and is the smallest; records
of equal payload and largest key, such as repeated rows, are all responses. A null url is
written as ``urn:page:KEY``; blanks and control characters in a url are percent-encoded. An
empty table gives an archive without files. Very long payloads are written whole, one record
in memory at a time. Extra columns are not archived.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.llm.tables import discarded, stored

FILE_BYTES = 32 << 20  # compressed
SHARD_BYTES = 64 << 20  # of payload
MOST_SHARDS = 100_000  # what the driver holds bounds of; beyond some 6 TB shards grow instead
DATE = "2000-01-01T00:00:00Z"  # the rows carry no date; a fixed one keeps files reproducible
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BINS = 1024
_FINER = 3  # bits by which a heavy bin is divided
_FILES = "shard int, seq int, temporary string, name string, records bigint, bytes bigint, sha1 string"
_RECORDS = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint, file string, payload binary"
)


def range_bounds(df: DataFrame, key: str, weight: str, n: int) -> tuple[list[int], dict[int, int]]:
    """At most ``n - 1`` keys that cut ``df`` into ranges of about equal weight, found in a
    histogram that is refined where a bin alone is too heavy; and the keys that are heavier than a
    range on their own, with the number of ranges they fill."""
    low, high, total = df.agg(F.min(key), F.max(key), F.sum(weight)).first()
    if low is None or n < 2 or not total:
        return [], {}
    share = total / n
    shift = max(0, ((high - low) // _BINS).bit_length())
    bins = _histogram(df, key, weight, shift)
    while shift and (heavy := [b for b, w in bins.items() if w > share]):
        parent, shift, fine = shift, max(0, shift - _FINER), {}
        among = df.sparkSession.createDataFrame([(b,) for b in heavy], "bin bigint")
        within = df.join(among, F.shiftright(key, parent) == F.col("bin"), "left_semi")
        parts = _histogram(within, key, weight, shift)
        for b, w in bins.items():
            if w <= share:
                fine[b << (parent - shift)] = w
        bins = {**fine, **parts}
    out, held, alone = [], 0.0, {}
    for b in sorted(bins):
        if not shift and bins[b] > 1.5 * share:
            alone[b] = round(bins[b] / share)
            out += [x for x in (b, b + 1) if x not in out[-1:]]
            continue
        if held >= share:
            out += [b << shift] if (b << shift) not in out[-1:] else []
            held = 0.0
        held += bins[b]
    return out, alone


def _histogram(df: DataFrame, key: str, weight: str, shift: int) -> dict[int, int]:
    bins = df.where(F.col(key).isNotNull()).groupBy(F.shiftright(key, shift).alias("bin")).agg(F.sum(weight).alias("w"))
    return {r["bin"]: r["w"] for r in bins.collect()}


def shard_numbers(bounds: list[int], alone: dict[int, int], first: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Of each range, the ones between ``bounds``, its first shard and how many it fills; and the number of
    all shards. The first ``first`` shards are left free."""
    fills = np.array([1, *(alone.get(b, 1) for b in bounds)], np.int64)
    ends = first + np.cumsum(fills)
    return ends - fills, fills, int(ends[-1])


def _shard(id_: Column, spread: Column, bounds: list[int], alone: dict[int, int], nulls: int, spark: SparkSession) -> tuple[Column, int]:
    """The shard of a key; keys that fill several shards, and null ones, are spread over theirs."""
    begins, fills, n = shard_numbers(bounds, alone, nulls)
    held = spark.sparkContext.broadcast((np.array(bounds, np.int64), begins, fills))  # 24 bytes a shard

    @F.pandas_udf("bigint")
    def place(ids: pd.Series) -> pd.Series:
        edges, begin, fill = held.value
        at = np.searchsorted(edges, ids.to_numpy(np.int64), side="right")
        return pd.Series(begin[at] << 20 | fill[at])

    found = place(F.coalesce(id_, F.lit(0)))
    within = F.shiftright(found, 20) + F.pmod(spread, found.bitwiseAND((1 << 20) - 1))
    return F.when(id_.isNull(), F.pmod(spread, F.lit(max(1, nulls)))).otherwise(within).cast("int"), n


def write(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    revisit_bytes: int = 0,
    file_bytes: int = FILE_BYTES,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Archive ``pages`` under ``path`` and return its manifest. Payloads shorter than
    ``revisit_bytes`` are always written in full."""
    content = F.coalesce(F.encode(F.col(payload), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(key).cast("bigint").alias("id"), F.col(url).alias("url"), content.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    # Sizes, owners and copies are found on narrow rows, so that payloads are read twice in all.
    sizes = stored(rows.select("id", "digest", F.octet_length("payload").cast("bigint").alias("size")), "warc-sizes")
    unnamed = F.sum(F.when(F.col("id").isNull(), F.col("size")))
    total, blank = (x or 0 for x in sizes.agg(F.sum("size"), unnamed).first())
    n = min(MOST_SHARDS, max(1, -(-total // shard_bytes)))
    bounds, alone = range_bounds(sizes.withColumn("weight", F.col("size") + 1), "id", "weight", n)
    nulls = min(n, -(-blank // shard_bytes)) if bounds or alone else 0
    shard, shards = _shard(F.col("id"), F.xxhash64("digest"), bounds, alone, nulls, pages.sparkSession)

    # One narrow row per revisit travels to the shard of its record and stands before it.
    owners = sizes.where(F.col("size") >= revisit_bytes).groupBy("digest").agg(
        F.max("id").alias("owner"), F.count("*").alias("copies")
    )
    owners = owners.where((F.col("copies") > 1) & F.col("owner").isNotNull()).drop("copies")
    copies = sizes.join(owners, "digest").where(~F.col("id").eqNullSafe(F.col("owner")))
    columns = ["shard", "id", "digest", "owner", "url", "payload"]
    notes = copies.select("id", "digest", "owner", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"))
    records = rows.withColumn("owner", F.lit(None).cast("bigint")).unionByName(notes).select(*columns[1:], shard.alias("shard"))
    order = [F.col("shard"), F.col("id"), F.col("digest"), F.col("payload").isNotNull(), F.col("url")]
    dealt = records.select(*columns).repartitionById(shards, F.col("shard")).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _write_shards(batches, path, file_bytes)

    staged = stored(dealt.mapInArrow(run, _FILES), "warc-staged")
    manifest = _commit(staged, path)
    discarded(sizes, staged)
    return manifest


def _write_shards(batches: Iterator[pa.RecordBatch], path: str, file_bytes: int) -> Iterator[pa.RecordBatch]:
    system, root = fs.FileSystem.from_uri(path)
    system.create_dir(f"{root}/_temporary", recursive=True)
    attempt = uuid.uuid4().hex
    out, shard, seq, note = None, None, 0, (None, None, None)

    def closed() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([out.close()], schema=_FILE_SCHEMA)

    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            if row["payload"] is None:
                note = row["id"], row["digest"], row["owner"]
                continue
            if out and (row["shard"] != shard or out.size >= file_bytes):
                yield closed()
                seq, out = (seq + 1 if row["shard"] == shard else 0), None
            if out is None:
                shard = row["shard"]
                out = _File(system, root, shard, seq, attempt)
            owner = note[2] if note[:2] == (row["id"], row["digest"]) else None
            out.add(record(row["id"], row["url"], row["payload"], owner))
    if out:
        yield closed()


_FILE_SCHEMA = pa.schema(
    [("shard", pa.int32()), ("seq", pa.int32()), ("temporary", pa.string()), ("name", pa.string())]
    + [("records", pa.int64()), ("bytes", pa.int64()), ("sha1", pa.string())]
)


class _File:
    """One archive file under its temporary name."""

    def __init__(self, system: fs.FileSystem, root: str, shard: int, seq: int, attempt: str) -> None:
        self.name = f"part-{shard:05d}-{seq:05d}.warc.gz"
        self.row = {"shard": shard, "seq": seq, "name": self.name, "temporary": f"_temporary/{attempt}-{self.name}"}
        self.stream = system.open_output_stream(f"{root}/{self.row['temporary']}", compression=None)
        self.digest, self.size, self.records = hashlib.sha1(), 0, -1
        info = b"format: WARC File Format 1.1\r\n"
        head = [("WARC-Type", "warcinfo"), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")]
        self.add(_framed(head, f"info:{self.name}", info))

    def add(self, data: bytes) -> None:
        member = gzip.compress(data, 6, mtime=0)
        self.stream.write(member)
        self.digest.update(member)
        self.size += len(member)
        self.records += 1

    def close(self) -> dict:
        self.stream.close()
        return {**self.row, "records": self.records, "bytes": self.size, "sha1": self.digest.hexdigest()}


def _commit(staged: DataFrame, path: str) -> DataFrame:
    """Rename the staged files and publish the manifest."""

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(path)
        for batch in batches:
            for row in batch.to_pylist():
                old, new = f"{root}/{row['temporary']}", f"{root}/{row['name']}"
                if system.get_file_info(old).type != fs.FileType.NotFound:
                    system.move(old, new)
                elif system.get_file_info(new).size != row["bytes"]:  # else an earlier attempt moved it
                    raise OSError(f"{new} is not the file of the manifest")
            yield batch

    spark = staged.sparkSession
    staged.mapInArrow(rename, _FILES).drop("temporary").write.parquet(f"{path}/manifest")
    system, root = fs.FileSystem.from_uri(path)
    if system.get_file_info(f"{root}/_temporary").type != fs.FileType.NotFound:
        system.delete_dir(f"{root}/_temporary")
    return spark.read.parquet(f"{path}/manifest")


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def _framed(head: list[tuple[str, str]], name: str, block: bytes) -> bytes:
    lines = [
        "WARC/1.1",
        *(f"{k}: {v}" for k, v in head),
        f"WARC-Record-ID: {_id(name)}",
        f"WARC-Date: {DATE}",
        f"WARC-Block-Digest: sha1:{base32(hashlib.sha1(block).digest())}",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def record(key: int | None, url: str | None, payload: bytes, owner: int | None) -> bytes:
    """A response, or a revisit of ``owner``, which keeps only the HTTP header."""
    digest = base32(hashlib.sha1(payload).digest())
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    # Header lines are ASCII: blanks, controls and other characters as percent escapes.
    target = re.sub(r"[^\x21-\x7e]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "") or f"urn:page:{key}"
    head = [("WARC-Type", "revisit" if owner is not None else "response"), ("WARC-Target-URI", target)]
    if key is not None:
        head.append(("X-Page-Id", str(key)))
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if owner is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _id(f"{owner}:{digest}")), ("X-Refers-To-Page-Id", str(owner))]
    return _framed(head, f"{key}:{digest}", http if owner is not None else http + payload)


def parse(stream: io.BufferedIOBase) -> Iterator[dict]:
    """Records of an opened archive; a payload that does not fit its digest is an error."""
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"no record begins with {line[:40]!r}")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            head[name] = value
        block = stream.read(int(head["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {head['WARC-Record-ID']} is cut short")
        if head["WARC-Type"] == "warcinfo":
            continue
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        response = head["WARC-Type"] == "response"
        if response and (len(payload) != size or base32(hashlib.sha1(payload).digest()) != digest):
            raise ValueError(f"record {head['WARC-Record-ID']} does not fit its digest")
        key, owner = head.get("X-Page-Id"), head.get("X-Refers-To-Page-Id")
        yield {
            "page_id": int(key) if key else None,
            "url": head["WARC-Target-URI"],
            "payload_bytes": size,
            "payload_digest": digest,
            "record_type": head["WARC-Type"],
            "refers_to": int(owner) if owner else None,
            "payload": payload if response else None,
        }


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per archived record of the files in the manifest; a task streams whole files."""
    files = spark.read.parquet(f"{path}/manifest").select("name")
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
        + [("record_type", pa.string()), ("refers_to", pa.int64()), ("file", pa.string()), ("payload", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(path)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                with system.open_input_stream(f"{root}/{name}", compression=None, buffer_size=1 << 20) as raw:
                    rows, held = [], 0
                    for row in parse(io.BufferedReader(gzip.GzipFile(fileobj=raw))):
                        row |= {"file": name} | ({} if payloads else {"payload": None})
                        rows.append(row)
                        held += 200 + len(row["payload"] or b"")
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    many = max(1, files.count())
    return files.repartition(many, "name").mapInArrow(run, _RECORDS)
