"""URL filters: rules by host and path, and an exact Bloom filter cascade behind them.

The first level of a cascade encodes the listed keys, the second those unlisted keys of the
universe that the first takes for listed, the third the listed keys that the second takes
for those, and so on until a level makes no error. As the universe holds every key of the
corpus, the first level without a key decides exactly, with no join against the list.

Keys are split by hash into shards of about ``shard_keys``; a task builds a shard's whole
cascade. Cascades are broadcast only in groups of at most ``broadcast_bytes``; a larger list
takes several groups, each one more narrow pass over the pages.

Defined cases. A null url and a url without ``://`` have an empty host and path, which no
rule fits and no list holds. Repeated rows each get a verdict; an empty table gives none.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgelake.llm.tables import free_names, stored
from forgelake.llm.textblocks import U64, mix

# Fixed values: (verdict, host, path) of the rules.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
BITS_PER_KEY = 4.0  # of the keys that a level encodes
HASHES = 3
SHARD_KEYS = 100_000
BROADCAST_BYTES = 32 << 20


def host_of(url: F.Column) -> F.Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: F.Column) -> F.Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: F.Column, path: F.Column, rules=RULES) -> F.Column:
    """The longest fitting rule as ``{rule, verdict}``, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _slots(hashes: np.ndarray, level: int, bits: int) -> np.ndarray:
    """Bit places of the keys at a level, one row per hash function."""
    a = mix(hashes ^ U64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64)))
    b = mix(a) | U64(1)
    return np.stack([(a + U64(i) * b) % U64(bits) for i in range(HASHES)])


def build(hashes: np.ndarray, listed: np.ndarray) -> list[np.ndarray]:
    """Levels of one cascade as bit arrays packed into bytes; keys must differ."""
    inside, outside, levels = hashes[listed], hashes[~listed], []
    while len(inside):
        bits = -(-max(64, int(BITS_PER_KEY * len(inside))) // 8) * 8
        field = np.zeros(bits, bool)
        field[_slots(inside, len(levels), bits)] = True
        levels.append(np.packbits(field))
        wrong = outside[field[_slots(outside, len(levels) - 1, bits)].all(axis=0)]
        inside, outside = wrong, inside
    return levels


def contains(levels: list[np.ndarray], hashes: np.ndarray) -> np.ndarray:
    """Membership of keys of the universe: the first level without the key tells."""
    out = np.zeros(len(hashes), bool)
    left = np.arange(len(hashes))
    for i, packed in enumerate(levels):
        bits = _level_bits(packed)
        slots = _slots(hashes[left], i, bits)
        there = ((packed[slots >> U64(3)] >> (U64(7) - (slots & U64(7))).astype(np.uint8)) & 1).all(axis=0)
        left = left[there]
        out[left] = i % 2 == 0
        if not len(left):
            break
    return out


def _level_bits(packed: np.ndarray) -> int:
    return len(packed) * 8


def cascades(universe: DataFrame, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int]:
    """From distinct ``key`` and ``listed`` one row ``shard, levels`` per shard, and the
    number of shards. Two keys of one 64-bit hash with different answers would be an error
    and are refused."""
    n = max(1, -(-universe.count() // shard_keys))

    def run(key: tuple[pa.Scalar, ...], frame: pa.Table) -> pa.Table:
        order = frame.column("hash").to_numpy().astype(U64).argsort()
        hashes = frame.column("hash").to_numpy().astype(U64)[order]
        listed = frame.column("listed").to_numpy(zero_copy_only=False)[order]
        same = hashes[1:] == hashes[:-1]
        if (same & (listed[1:] != listed[:-1])).any():
            raise ValueError("two keys of one hash, of which one is listed: choose another hash seed")
        levels = [x.tobytes() for x in build(hashes, listed)]
        return pa.table({"shard": [key[0].as_py()], "levels": pa.array([levels], pa.list_(pa.binary()))})

    hashed = universe.select(F.xxhash64("key").alias("hash"), "listed").withColumn("shard", F.pmod("hash", F.lit(n)))
    return hashed.groupBy("shard").applyInArrow(run, "shard bigint, levels array<binary>"), n


def exact_member(
    df: DataFrame,
    key: str,
    universe: DataFrame,
    shard_keys: int = SHARD_KEYS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``df`` with boolean ``listed`` for its ``key``, whose values must all be in
    ``universe(key, listed)``; a null key is not listed."""
    spark = df.sparkSession
    built, n = cascades(universe, shard_keys)
    built = stored(built, "url-cascades")
    sizes = built.select("shard", F.aggregate("levels", F.lit(0), lambda a, x: a + F.octet_length(x)).alias("b"))
    total = sizes.agg(F.sum("b")).first()[0] or 0
    groups = max(1, -(-total // broadcast_bytes))
    df = df.select(*[c for c in df.columns if c != "listed"], F.lit(False).alias("listed"))
    for group in range(groups):
        rows = built.where(F.pmod("shard", F.lit(groups)) == group).collect()
        held = spark.sparkContext.broadcast({r["shard"]: [bytes(x) for x in r["levels"]] for r in rows})
        df = _lookup(df, key, held, n)
    return df


def _lookup(df: DataFrame, key: str, held, n: int) -> DataFrame:
    hashed_as, = free_names(df.columns, "key_hash")
    hashed = df.withColumn(hashed_as, F.when(F.col(key).isNotNull(), F.xxhash64(key)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = {s: [np.frombuffer(x, np.uint8) for x in xs] for s, xs in held.value.items()}
        for batch in batches:
            column = batch.column(hashed_as)
            known = column.is_valid().to_numpy(zero_copy_only=False)
            signed = column.fill_null(0).to_numpy(zero_copy_only=False)
            listed = batch.column("listed").to_numpy(zero_copy_only=False).copy()
            shards = np.mod(signed, n)
            for shard in np.unique(shards[known]).tolist():
                if shard in levels:
                    at = np.flatnonzero(known & (shards == shard))
                    listed[at] = contains(levels[shard], signed[at].astype(U64))
            arrays = [pa.array(listed) if f.name == "listed" else batch.column(f.name) for f in batch.schema][:-1]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names[:-1])

    return hashed.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType) for f in df.schema]))


def insecure_hosts(parts: DataFrame) -> DataFrame:
    """The complete universe of hosts; listed are those never seen over https."""
    secure = F.max(F.lower(F.substring_index("url", "://", 1)) == "https")
    return parts.where(F.col("host") != "").groupBy(F.col("host").alias("key")).agg((~secure).alias("listed"))


def judge(pages: DataFrame, universe=insecure_hosts, rules=RULES, **limits: int) -> DataFrame:
    """Verdict per page: the longest rule's, else block if the host is listed, else allow."""
    url = F.col("url")
    parts = pages.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"))
    narrow = parts.select("page_id", "host", "path", rule_of(F.col("host"), F.col("path"), rules).alias("fit"))
    narrow = narrow.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("by_rule"))
    found = exact_member(narrow, "host", universe(parts), **limits)
    method = F.when(F.col("listed") & (F.col("host") != ""), F.lit("block")).otherwise(F.lit("allow"))
    return found.select("page_id", "host", "path", "rule", F.coalesce("by_rule", method).alias("verdict"))
