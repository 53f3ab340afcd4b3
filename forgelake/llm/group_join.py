"""Exact n-gram Jaccard join by grouped prefixes.

A text is the set of its shingles of ``WORDS`` words; a text of fewer words, but not none, has
one shingle. Two texts are linked if their sets' Jaccard coefficient is at least
``percent`` / 100, compared in integers; components are what links connect.

Order. Any fixed order of shingles gives each of two linked sets a common one among its first
``n - ceil(t n) + 1``, its prefix. Here a quarter of all shingles, chosen by their hash, come
first, the rarest foremost, and the others follow by hash: only that quarter is counted
and joined, whose rarest are the prefix of nearly every text. Shingles in one text only are
counted off and not shuffled again; a text whose prefix consists of them is linked to nothing.

Grouped join. Texts of equal sets are one node. Nodes of equal prefix and size are one group. Groups
meet in the lists of their prefixes' shingles; pairs are filtered by their sizes and by how much
the places of the common shingle leave, then expanded to the nodes and verified by intersection.

Long lists. A shingle in the prefixes of more than ``_SHORT`` nodes would make as many pairs as
the square of its list. Their nodes are dealt to tiles instead, by the most frequent shingle of
the prefix and by size; two tiles meet once if they share such a shingle and their sizes
allow a link. One task counts all intersections of two tiles as a matrix product over
the shingles they share, and returns a spanning forest of the links: as many rows as nodes,
not pairs. Nothing is left out: every pair with a common prefix shingle is verified by one way
or the other.

Shingles are compared by 64-bit hashes: two sets of a thousand differ from the truth with a
probability of some 1e-13.

Defined cases. A document without words, or with null text, has an empty set and is linked
with nothing. Very long texts take part whole; a tile holds at least one of them. Rows of
one id are one document, linked by each of its sets, whose size is the largest of them.
Rows without id are left out. Repeated rows change nothing; ties in frequency fall to the
hash. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.llm.components import components
from forgelake.llm.tables import stored
from forgelake.llm.tiles import fill_tiles, tile_links
from forgelake.llm.textblocks import SPACE, raw_texts, shingles_of, slices, words_of

WORDS, PERCENT = 4, 85
_COUNTED = 4  # one shingle in so many is counted; a power of two
_UNIT = 1 << 20  # bytes of text whose shingles are held together
_SHORT = 8  # nodes of a list whose groups are paired directly
_TILE = 256  # nodes in a tile, about
_SALTS = 16
# ASCII white space separates words, A-Z are folded, all other bytes stay as they are.
_FOLD = bytes(SPACE if b == 32 or 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def _sets_of(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, in ascending order text by text, and where each text's begin."""
    hashes, rows = shingles_of(words_of(texts, _FOLD), len(texts), WORDS)
    hashes = hashes.view(np.int64)
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    hashes, rows = hashes[new], rows[new]
    return hashes, np.searchsorted(rows, np.arange(len(texts) + 1))


def _key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def counted(shingles: np.ndarray) -> np.ndarray:
    """Which shingles come first in the order."""
    return (shingles & (_COUNTED - 1)) == 0


def described(docs: DataFrame, percent: int) -> DataFrame:
    """``node, doc_id, key, n, first``: a row's key is that of its set, ``first`` are the counted
    shingles and, where these are fewer than the prefix, the next ones in order."""
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64())]
    names = ["doc_id", "key", "n", "first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _UNIT):
            hashes, ends = _sets_of(raw_texts(batch, "text"))
            keys, firsts = [], []
            for a, b in zip(ends, ends[1:]):
                own = hashes[a:b]
                keys.append(_key(own))
                ahead = counted(own)
                missing = len(own) - -(-len(own) * percent // 100) + 1 - int(ahead.sum()) if len(own) else 0
                rest = own[~ahead][: max(0, missing)]
                firsts.append(np.concatenate([own[ahead], rest]))
            offsets = np.cumsum([0, *(len(f) for f in firsts)])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(firsts)))
            arrays = [batch.column("doc_id"), pa.array(keys, pa.binary()), pa.array(np.diff(ends)), lists]
            yield pa.RecordBatch.from_arrays([a.cast(k) for a, k in zip(arrays, kinds)], names=names)

    found = docs.mapInArrow(run, "doc_id bigint, key binary, n bigint, first array<bigint>")
    return found.withColumn("node", F.monotonically_increasing_id())


def whole_sets(docs: DataFrame) -> DataFrame:
    """``doc_id, key, shingles`` of all rows."""
    names = ["doc_id", "key", "shingles"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _UNIT):
            hashes, ends = _sets_of(raw_texts(batch, "text"))
            keys = [_key(hashes[a:b]) for a, b in zip(ends, ends[1:])]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(hashes))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(keys, pa.binary()), lists], names=names)

    return docs.mapInArrow(run, "doc_id bigint, key binary, shingles array<bigint>")


def least_overlap(n: Column, percent: int) -> Column:
    """Common shingles that a set of ``n`` needs with any partner."""
    return F.floor((n * percent + 99) / 100).cast("bigint")


def _fits(n: str, m: str, percent: int) -> Column:
    """Sizes that allow a link."""
    small, large = F.least(n, m), F.greatest(n, m)
    return small * 100 >= large * percent


def prefixed(base: DataFrame, percent: int) -> DataFrame:
    """``node, n, own, first``: how many shingles of the prefix no other text has, and its others in
    order with their frequency; without the nodes that have none of these."""
    late = F.col("shingle").bitwiseAND(_COUNTED - 1) != 0
    places = base.select("node", "n", F.size("first").alias("listed"), F.explode("first").alias("shingle"))
    counts = places.where(~late).groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    both = places.where(~late).join(counts, "shingle").select("node", "n", "listed", "shingle", "df", F.lit(False).alias("late"))
    rest = places.where(late).select("node", "n", "listed", "shingle", F.lit(0).cast("bigint").alias("df"), F.lit(True).alias("late"))
    listed = both.union(rest).groupBy("node", "n", "listed").agg(
        F.sort_array(F.collect_list(F.struct("late", "df", "shingle"))).alias("all")
    )
    own = (F.col("listed") - F.size("all")).cast("bigint")
    prefix = F.col("n") - least_overlap(F.col("n"), percent) + 1
    return listed.where(own < prefix).select(
        "node", "n", own.alias("own"), F.slice("all", F.lit(1), (prefix - own).cast("int")).alias("first")
    )


def groups_of(prefixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups of equal prefix and size, ``group, n, own, first, members``, and ``group, node``.
    A prefix with shingles of its own is like no other."""
    alone = F.when(F.col("own") > 0, F.col("node"))
    key = F.sha2(F.concat_ws(",", F.col("n"), F.col("first.shingle").cast("array<string>"), alone), 256)
    named = prefixes.withColumn("prefix_key", key)
    groups = named.groupBy("prefix_key").agg(
        F.min("node").alias("group"), F.count(F.lit(1)).alias("members")
    )
    # The group's first node stands for its prefix; nodes learn their group.
    heads = named.select(F.col("node").alias("group"), "prefix_key", "n", "own", "first")
    heads = groups.join(heads, ["prefix_key", "group"])
    small = named.select("prefix_key", "node").join(groups.select("prefix_key", "group"), "prefix_key")
    return heads.drop("prefix_key"), small.select("group", "node")


def _verified(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` of nodes that are linked."""
    sides = [nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("shingles").alias(f"s_{x}")) for x in "ab"]
    joined = pairs.join(sides[0], "a").join(sides[1], "b")
    both = F.size(F.array_intersect("s_a", "s_b")).cast("bigint")
    return joined.where(both * 100 >= (F.col("n_a") + F.col("n_b") - both) * percent).select("a", "b")


def _short_pairs(lists: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes of groups that meet in short lists and pass the filters."""
    other = lists.select("shingle", *(F.col(c).alias(f"{c}_b") for c in ("group", "n", "place", "members")))
    met = lists.join(other, "shingle").where(F.col("group") <= F.col("group_b")).where(_fits("n", "n_b", percent))
    # At most the common shingle and what both have behind it is shared.
    rest = F.least(F.col("n") - F.col("place"), F.col("n_b") - F.col("place_b"))
    met = met.where(rest * 100 >= (F.col("n") + F.col("n_b") - rest) * percent)
    met = met.where("group < group_b OR members > 1").select("group", "group_b").distinct()
    a, b = (members.select(F.col("group").alias(g), F.col("node").alias(x)) for g, x in (("group", "a"), ("group_b", "b")))
    pairs = met.join(a, "group").join(b, "group_b").where("group < group_b OR a < b")
    return pairs.select("a", "b")


def _tiled(long: DataFrame, members: DataFrame, tile_nodes: int) -> DataFrame:
    """Tiles of the nodes of groups in long lists."""
    crowd = F.max(F.struct("nodes", "shingle")).alias("crowd")
    dealt = long.groupBy("group", "n").agg(crowd, F.collect_set("shingle").alias("lists"))
    dealt = dealt.select("group", "n", "lists", F.col("crowd.shingle").alias("crowd"))
    return fill_tiles(dealt.join(members, "group").select("node", "n", "lists", "crowd"), tile_nodes)


def _salted(df: DataFrame) -> DataFrame:
    return df.withColumn("salt", F.explode(F.array(*map(F.lit, range(_SALTS)))))


def _with_heads(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows with the node of their set. Only sets of several rows are looked up, spread by a salt,
    as one set may be a third of all rows."""
    several = _salted(keys.where("rows > 1").select("key", "head"))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(_SALTS)).cast("int"))
    return dealt.join(several, ["key", "salt"], "left").select("doc_id", "n", F.coalesce("head", "node").alias("head"))


def _named(labelled: DataFrame, texts: DataFrame) -> DataFrame:
    """One row per document, named by the smallest id of its label."""
    smallest = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("rows"))
    several = _salted(smallest.where("rows > 1").drop("rows"))
    dealt = labelled.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS)).cast("int"))
    found = dealt.join(several, ["label", "salt"], "left")
    found = found.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    ids = texts.select("doc_id", F.lit(0).cast("bigint").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return found.union(ids).groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"), F.min("component_id").alias("component_id"))


def classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    short: int = _SHORT,
    tile_nodes: int = _TILE,
) -> DataFrame:
    """``doc_id, n_shingles, component_id``: one row per document, the component being named by
    its smallest id."""
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    texts = texts.where("doc_id IS NOT NULL")
    base = stored(described(texts, percent), "first-shingles")
    # Rows of equal sets are one node, the first; rows of one id with different sets are linked.
    sizes = base.where("n > 0").groupBy("key").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("rows"))
    keys = stored(sizes, "set-keys")
    prefixes = prefixed(base, percent).join(keys.select(F.col("head").alias("node")), "node", "left_semi")
    groups, members = groups_of(stored(prefixes, "prefixes"))
    groups, members = stored(groups, "groups"), stored(members, "group-members")

    lists = groups.select("group", "n", "own", "members", F.posexplode("first").alias("at", "entry"))
    lists = lists.select(F.col("entry.shingle").alias("shingle"), "group", "n", "members", (F.col("own") + F.col("at")).alias("place"))
    crowds = lists.groupBy("shingle").agg(F.sum("members").alias("nodes")).where("nodes > 1")
    lists = stored(lists.join(crowds, "shingle"), "prefix-lists")
    pairs = stored(_short_pairs(lists.where(F.col("nodes") <= short), members, percent), "node-pairs")
    tiles = stored(_tiled(lists.where(F.col("nodes") > short), members, tile_nodes), "tiled-nodes")

    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(tiles.select("node")).distinct()
    names = base.select("node", "doc_id", "key", "n").join(wanted, "node", "left_semi")
    asked = texts.join(names.select("doc_id").distinct(), "doc_id", "left_semi")
    nodes = whole_sets(asked).dropDuplicates(["doc_id", "key"]).join(names, ["doc_id", "key"])
    nodes = stored(nodes.select("node", "n", "shingles"), "node-sets")

    labelled = base.where("n > 0").select("node", "doc_id", "n", "key")
    labelled = stored(_with_heads(labelled, keys), "members")
    ties = labelled.groupBy("doc_id").agg(F.min("head").alias("a"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    ties = labelled.join(ties, "doc_id").select("a", F.col("head").alias("b")).where("a <> b").distinct()
    links = _verified(pairs, nodes, percent).union(tile_links(tiles, nodes, percent)).union(ties)
    labels = components(links).withColumnRenamed("node", "head")
    named = labelled.select("doc_id", "n", "head").join(labels, "head", "left")
    named = stored(named.select("doc_id", "n", F.coalesce("label", "head").alias("label")), "labelled")
    return _named(named, texts)
