"""Near-duplicate classes by DartMinHash signatures, banding and exact verification.

A text is the weighted set of its shingles of five words, weighted by how often each occurs;
a text of fewer words, but not none, has one shingle. Similarity is the weighted Jaccard
coefficient: the sum of the smaller weights over the sum of the larger. Two documents are
linked if it is at least ``threshold``, and classes are the connected components.

Signature: every element has an endless sequence of darts, which a hash of the element
throws into its region; a dart has a place on the element's weight axis, a rank (its arrival
in a unit-rate process) and one of ``k`` coordinates. Darts within the element's weight count,
and of each coordinate the dart of lowest rank is kept. All darts below a rank that shrinks
with the text's total weight are thrown at once, some k ln k + 2k in all, however many
elements there are; texts with empty coordinates are thrown at again up to twice the rank.

Candidates: texts of equal word sequence are one node, represented by the smallest id. Nodes
that agree in two near bands of the signature form a bucket: eight agreeing coordinates keep
texts apart that merely share a passage, and as the pairs of bands are many a pair at the
threshold is missed with a probability of some 1e-4. Nodes of a short bucket are compared pair
by pair. Those of longer ones are dealt to tiles, which meet once if they share a bucket, and
all pairs of two tiles are counted at once: a group of copies, or many texts with a passage in
common that are not alike, give rows in proportion to their number, not to its square.

Defined cases. A null text is similar to nothing. Texts without words are alike if they are
equal. Rows without id have no class and are not linked. Rows of one id are one document: the
links of all of them hold, and the result has one row for it. Empty tables give no rows;
extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forgelake.llm.components import components
from forgelake.llm.tables import discarded, free_names, sifted, stored
from forgelake.llm.tiles import crowds_of, fill_tiles, tile_links
from forgelake.llm.textblocks import FOLD, U64, mix, raw_texts, shingles_of, slices, words_of

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
NEAR = (1, 2, 3, 4)  # distances of the bands that are paired
_UNIT, _UNIT_ROWS = 1 << 18, 256  # bytes and rows of text whose darts are thrown together
_NEXT = 0x9E3779B97F4A7C15
_SHORT = 4  # nodes of a bucket that are paired directly
_TILE = 1024  # nodes in a tile, about
_SALTS = 16


def weighted(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct elements of each row with their counts."""
    order = np.lexsort((hashes, rows))
    h, r = hashes[order], rows[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(new)
    return h[at], r[at], np.diff(np.append(at, len(h))).astype(np.float64)


def signatures(elements: np.ndarray, rows: np.ndarray, weights: np.ndarray, n_rows: int, k: int) -> np.ndarray:
    """One row of ``k`` 64-bit values per text; a text without elements has zeros."""
    out = np.zeros((n_rows, k), U64)
    # The weight axis is cut into cells of unit width, each with a sequence of its own.
    cells = np.maximum(1, np.ceil(weights)).astype(np.int64)
    cell = np.arange(cells.sum()) - np.repeat(np.cumsum(cells) - cells, cells)
    seeds = mix(np.repeat(elements, cells) + cell.astype(U64) * U64(_NEXT))
    owners, room = np.repeat(rows, cells), np.repeat(weights, cells) - cell
    total = np.bincount(rows, weights, n_rows)
    todo = np.flatnonzero(total > 0)
    limit = np.zeros(n_rows)
    limit[todo] = (k * math.log(k) + 2 * k) / total[todo]
    active = np.ones(len(seeds), bool)
    while len(todo):
        coordinate, value = _thrown(seeds[active], owners[active], room[active], limit, k)
        out.reshape(-1)[coordinate] = value
        full = np.bincount(coordinate // k, minlength=n_rows)
        todo = todo[full[todo] < k]
        limit[todo] *= 2
        again = np.zeros(n_rows, bool)
        again[todo] = True
        active = again[owners]
    return out


def _thrown(seeds, owners, room, limit, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The earliest dart below the owner's limit at each (owner, coordinate)."""
    rank, state = np.zeros(len(seeds)), seeds
    ranks, slots, values = [], [], []
    while len(state):
        state = mix(state + U64(_NEXT))
        # Arrival times: gaps are exponential.
        rank = rank - np.log(((state >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53)
        near = rank < limit[owners]
        state, rank, owners, room = state[near], rank[near], owners[near], room[near]
        dart = mix(state ^ U64(0xD1B54A32D192ED03))
        inside = (dart >> U64(11)).astype(np.float64) * 2.0**-53 < room
        value = mix(dart + U64(_NEXT))
        ranks.append(rank[inside])
        slots.append((owners * k + ((value >> U64(32)) % U64(k)).astype(np.int64))[inside])
        values.append(value[inside])
    rank, slot, value = (np.concatenate(x) if x else np.zeros(0) for x in (ranks, slots, values))
    order = np.lexsort((value, rank, slot))
    slot, value = slot[order].astype(np.int64), value[order]
    first = np.ones(len(slot), bool)
    first[1:] = slot[1:] != slot[:-1]
    return slot[first], value[first]


def bucket_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One signed 64-bit hash per pair of near bands, different pairs apart."""
    parts = signature.reshape(len(signature), bands, rows)
    band = np.broadcast_to(mix(np.arange(1, bands + 1).astype(U64)), (len(signature), bands)).copy()
    for i in range(rows):
        band = mix(band ^ parts[:, :, i]) + U64(_NEXT)
    pairs = [mix(band + np.roll(band, -d, axis=1) * U64(2 * d + 1)) for d in NEAR]
    return np.concatenate(pairs, axis=1).view(np.int64)


def _sequence_key(text: bytes) -> bytes:
    """128-bit hash of the word sequence, or of the text itself if it has no word."""
    words = b" ".join(text.translate(FOLD).split())
    return xxhash.xxh3_128_digest(b"w" + words if words else b"t" + text)


def signed(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """``doc_id, key, n, buckets`` of the documents with id and text, ``n`` being the total weight."""
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.binary()), ("n", pa.int64()), ("buckets", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _UNIT, _UNIT_ROWS):
            texts = raw_texts(batch, "text")
            shingles = shingles_of(words_of(texts), len(texts), WORDS)
            elements, owners, weights = weighted(*shingles)
            signature = signatures(elements, owners, weights, len(texts), bands * rows)
            found = bucket_hashes(signature, bands, rows)
            has = np.bincount(owners, minlength=len(texts)) > 0
            ends = np.cumsum([0, *np.where(has, found.shape[1], 0)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found[has].ravel()))
            columns = [batch.column("doc_id"), pa.array([_sequence_key(t) for t in texts], pa.binary())]
            columns += [pa.array(np.bincount(owners, weights, len(texts)).astype(np.int64)), lists]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    return narrow.mapInArrow(run, "doc_id bigint, key binary, n bigint, buckets array<bigint>")


def similarity(a: bytes, b: bytes) -> float:
    """Weighted Jaccard coefficient of two texts' shingles."""
    words = words_of([a, b])
    elements, owners, weights = weighted(*shingles_of(words, 2, WORDS))
    x, y = ((elements[owners == i], weights[owners == i]) for i in (0, 1))
    if not len(x[0]) or not len(y[0]):
        return float(a == b)
    _, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    both = np.minimum(x[1][i], y[1][j]).sum()
    return float(both / (x[1].sum() + y[1].sum() - both))


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The distinct ``a, b`` of ``pairs`` whose texts are similar."""
    b_side = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("b_text"))
    a_side = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("a_text"))
    joined = pairs.join(b_side, "b").join(a_side, "a").select("a", "b", "a_text", "b_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = zip(raw_texts(batch, "a_text"), raw_texts(batch, "b_text"))
            keep = pa.array([similarity(x, y) >= threshold for x, y in texts], pa.bool_())
            yield batch.select(["a", "b"]).filter(keep)

    return joined.mapInArrow(run, "a bigint, b bigint").distinct()


def weighted_sets(texts: DataFrame) -> DataFrame:
    """``node, n, shingles``: an element of weight w as w elements, so that the intersection of two
    sets is the sum of the smaller weights."""
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _UNIT):
            texts = raw_texts(batch, "text")
            elements, owners, weights = weighted(*shingles_of(words_of(texts), len(texts), WORDS))
            times = weights.astype(np.int64)
            place = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            units = mix(np.repeat(elements, times) + place.astype(U64) * U64(_NEXT)).view(np.int64)
            ends = np.searchsorted(np.repeat(owners, times), np.arange(len(texts) + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(units))
            arrays = [batch.column("node"), pa.array(np.diff(ends)), lists]
            yield pa.RecordBatch.from_arrays([a.cast(k) for a, k in zip(arrays, kinds)], names=["node", "n", "shingles"])

    return texts.mapInArrow(run, "node bigint, n bigint, shingles array<bigint>")


def classes(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, class_id``: one row per document with text, the class being named by its
    smallest id."""
    sig = stored(signed(docs, bands, rows), "signatures")
    keys = stored(sig.groupBy("key").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("rows")), "nodes")
    members = stored(_members(sig.select("doc_id", "key").distinct(), keys), "members")
    # One row per key: copies fall together before the shuffle.
    heads = sig.groupBy("key").agg(F.min(F.struct("doc_id", "n", "buckets")).alias("head")).select("head.*")
    heads = stored(heads.select(F.col("doc_id").alias("node"), "n", F.array_distinct("buckets").alias("buckets")), "heads")
    discarded(sig)
    places = heads.select(F.explode("buckets").alias("bucket"), "node", "n")
    sizes = places.groupBy("bucket").agg(F.count("*").alias("nodes")).where("nodes > 1")
    shared = stored(places.join(sizes, "bucket"), "buckets")
    discarded(heads)

    short = shared.where(F.col("nodes") <= _SHORT).select("bucket", "node", "n")
    other = short.select("bucket", F.col("node").alias("b"), F.col("n").alias("m"))
    pairs = short.join(other, "bucket").where(F.col("node") < F.col("b"))
    pairs = pairs.where(F.least("n", "m") >= F.greatest("n", "m") * (threshold - 1e-9))
    pairs = stored(pairs.select(F.col("node").alias("a"), "b").distinct(), "pairs")
    # Written, as it is read twice: the nodes of long buckets are joined with them once.
    dealt = stored(crowds_of(shared.where(F.col("nodes") > _SHORT).withColumnRenamed("bucket", "list")), "dealt")
    tiles = stored(fill_tiles(dealt, _TILE), "tiled-nodes")
    discarded(shared, dealt)

    # The texts that take part in any comparison, once. Rows of one id may differ in text; they
    # are one document, so any of its texts may tie it to another.
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).union(tiles.select("node")).distinct()
    wanted = stored(wanted, "wanted")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("text IS NOT NULL")
    texts = sifted(texts, wanted, "doc_id").join(wanted, "doc_id", "left_semi")
    texts = stored(texts.distinct(), "candidate-texts")
    in_tiles = texts.join(tiles.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = weighted_sets(in_tiles.select(F.col("doc_id").alias("node"), "text"))

    # Rows of one id with different texts tie their nodes together.
    ties = members.groupBy("doc_id").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1")
    ties = members.join(ties, "doc_id").select("a", F.col("node").alias("b")).where("a <> b")
    links = verified(pairs, texts, threshold).union(tile_links(tiles, sets, threshold * 100)).union(ties)
    labels = components(links)
    discarded(pairs, tiles, wanted, texts)
    named = members.join(labels, "node", "left").select("doc_id", F.coalesce("label", "node").alias("class_id"))
    return named.groupBy("doc_id").agg(F.min("class_id").alias("class_id"))


def _members(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``doc_id, node`` of all rows. Only keys of several rows are looked up, spread by a salt, as
    one text may be a third of all rows."""
    several = keys.where("rows > 1").select("key", "node", F.explode(F.array(*map(F.lit, range(_SALTS)))).alias("salt"))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS)).cast("int"))
    found = dealt.join(several, ["key", "salt"], "left")
    return found.select("doc_id", F.coalesce("node", "doc_id").alias("node")).distinct()


def report(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: its class, and whether it is the one that stays. A document
    whose text is null is a class of its own."""
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    found = ids.join(classes(docs, threshold), "doc_id", "left")
    found = found.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
    return found.withColumn("kept", F.col("doc_id") == F.col("class_id"))


def drop_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, the one of the smallest id; rows without id all stay. Of
    several rows of one id, one document, the one stays whose columns hash lowest, ties falling
    to equal rows, so that every run keeps the same."""
    found = classes(docs, threshold)
    gone = found.where("doc_id <> class_id").select("doc_id")
    kept = docs.join(gone, docs["doc_id"].cast("bigint") == gone["doc_id"], "left_anti")
    rank, = free_names(docs.columns, "rank")
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64(*docs.columns), *docs.columns)
    named = kept.where("doc_id IS NOT NULL").withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1)
    return named.drop(rank).union(kept.where("doc_id IS NULL"))
