"""Links between sets in long lists, tile against tile.

Pairs of a list grow with the square of its length. Here its nodes are dealt to tiles, and two
tiles that share a list meet once: one task counts all intersections between them as a
matrix product over the elements they share, and returns a spanning forest of the links, as
many rows as nodes. A tile holds some hundreds of nodes, or a bounded number of elements, or a
single larger set.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.llm.tables import stored

_ELEMENTS = 1 << 20  # in a tile
_COLUMNS = 4096  # elements of one matrix product
_CLASS = 1.2  # ratio of the sizes that share a tile


def linked(common: np.ndarray, n: np.ndarray, m: np.ndarray, percent: float) -> np.ndarray:
    """Which sets of sizes ``n`` and ``m`` are similar enough, by the sizes of their intersections."""
    return 100 * common >= percent * (n[:, None] + m[None, :] - common)


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets."""
    both = np.concatenate([*left, *right]) if left or right else np.zeros(0, np.int64)
    rows = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in [*left, *right]])
    _, column, times = np.unique(both, return_inverse=True, return_counts=True)
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    # Shingles of one side only are in no intersection.
    first_right = np.zeros(len(times), np.int64)
    np.add.at(first_right, column, rows >= len(left))
    useful = (first_right > 0) & (first_right < times)
    kept = useful[column]
    rows = rows[kept]
    column = (np.cumsum(useful) - 1)[column[kept]]
    out = np.zeros((len(left), len(right)), np.int64)
    n_columns = int(useful.sum())
    starts = np.searchsorted(column, np.arange(0, n_columns + _COLUMNS, _COLUMNS))
    for i, (a, b) in enumerate(zip(starts, starts[1:])):
        table = np.zeros((len(left) + len(right), min(_COLUMNS, n_columns - i * _COLUMNS)), np.float32)
        table[rows[a:b], column[a:b] - i * _COLUMNS] = 1
        out += (table[: len(left)] @ table[len(left) :].T).astype(np.int64)
    return out


def forest(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect the nodes as the links do: each node with the first of its component."""
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    i, j = np.nonzero(linked)
    i, j = at[i], at[len(left) + j]
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            break
        label = new
    far = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[label[far]], nodes[far]


def crowds_of(places: DataFrame) -> DataFrame:
    """``node, n, lists, crowd`` from rows ``list, node, n, nodes`` of long lists. The members of a group of
    copies with changes of their own are each in other lists, so a node does not take its own most
    crowded list but the most crowded of all that share a list with it: groups fill few tiles."""
    best = F.max(F.struct("nodes", "list"))
    mine = places.groupBy("node").agg(best.alias("mine"))
    named = places.join(mine, "node")
    lists = named.groupBy("list").agg(F.max("mine").alias("best"))
    found = places.select("list", "node", "n").join(lists, "list").groupBy("node", "n").agg(
        F.max("best").alias("best"), F.collect_set("list").alias("lists")
    )
    return found.select("node", "n", "lists", F.col("best.list").alias("crowd"))


def fill_tiles(dealt: DataFrame, tile_nodes: int) -> DataFrame:
    """``tile, node, n, lists`` of nodes with the lists they are in and the one of these that is most
    crowded. Tiles go by this list and by a class of size, and are filled by a hash."""
    size = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(_CLASS))).cast("int")
    dealt = dealt.withColumn("size", size)
    fill = dealt.groupBy("crowd", "size").agg(F.count(F.lit(1)).alias("count"), F.sum("n").alias("held"))
    chunks = F.greatest(F.ceil(F.col("count") / tile_nodes), F.ceil(F.col("held") / _ELEMENTS))
    dealt = dealt.join(fill.select("crowd", "size", chunks.alias("chunks")), ["crowd", "size"])
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks"))
    return dealt.select(F.xxhash64("crowd", "size", chunk).alias("tile"), "node", "n", "lists")


def tile_links(tiles: DataFrame, sets: DataFrame, percent: float) -> DataFrame:
    """``a, b``: forests of the links between the nodes of tiles that share a list. ``sets`` has
    ``node, n, shingles``, several rows of a node if it has several sets."""
    seen = tiles.select("tile", "n", F.explode("lists").alias("list"))
    seen = seen.groupBy("list", "tile").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    seen = stored(seen, "tile-lists")
    # A tile meets itself once, without a look at its lists.
    other = seen.select("list", *(F.col(c).alias(f"{c}_b") for c in ("tile", "low", "high")))
    fit = (F.col("low_b") * percent <= F.col("high") * 100) & (F.col("low") * percent <= F.col("high_b") * 100)
    met = seen.join(other, "list").where(F.col("tile") < F.col("tile_b")).where(fit)
    met = stored(met.select("tile", "tile_b").distinct(), "tile-pairs")
    full = stored(tiles.select("tile", "node").join(sets, "node").select("tile", "node", "n", "shingles"), "tiles")
    columns = ["tile", "tile_b", "side", "node", "n", "shingles"]
    own = full.withColumns({"tile_b": F.col("tile"), "side": F.lit(0)})
    left = met.join(full, "tile").withColumn("side", F.lit(0))
    right = met.join(full.withColumnRenamed("tile", "tile_b"), "tile_b").withColumn("side", F.lit(1))

    def run(pair: pa.Table) -> pa.Table:
        side = pair.column("side").to_numpy()
        node, n = pair.column("node").to_numpy(), pair.column("n").to_numpy()
        lists = pair.column("shingles").combine_chunks()
        ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        held = [flat[a:b] for a, b in zip(ends, ends[1:])]
        a = np.flatnonzero(side == 0)
        b = np.flatnonzero(side == 1) if (side == 1).any() else a
        common = intersections([held[i] for i in a], [held[i] for i in b])
        x, y = forest(linked(common, n[a], n[b], percent), node[a], node[b])
        return pa.table({"a": pa.array(x, pa.int64()), "b": pa.array(y, pa.int64())})

    pairs = own.select(columns).union(left.select(columns)).union(right.select(columns))
    return pairs.groupBy("tile", "tile_b").applyInArrow(run, "a bigint, b bigint")
