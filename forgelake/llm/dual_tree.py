"""Vector code compression: Lloyd's rounds over parts of vectors by pairs of trees.

A vector of integers is cut into ``parts`` nearly equal consecutive parts, and each part position
has a codebook; a vector's code names the nearest entry of each. The codebooks start as
the parts of the first vectors and move to the mean of what is assigned to them, rounded down,
for a number of rounds. All distances and means are exact: doubles are used for integers they hold.

Trees. The vectors are written once as blocks of up to ``_BLOCK`` rows whose parts stand in
the order of a balanced tree (halved along the widest side), so that the tree needs no more
than its level to be known. In each round a block's nodes get their boxes and sums, and
the codebook a tree of its own. Both are walked down together: of all pairs of a node of parts
and a node of entries those stay whose least distance does not exceed what some other
entry node surely offers. A node of parts left with a single entry is assigned as a
whole by its cached sum; leaves that stay uncertain are settled by integer distances.

One round is one Spark job: tasks walk their blocks and add up per entry, Spark adds the sums
of the tasks, and the driver holds just the codebooks, ``entries`` times the vectors'
length. Numbers too large for that are carried as Python integers and their sums as limbs.

Defined cases. Rows whose vector is null or holds a null or non-finite component take no part,
also where scaling makes one infinite, and neither do rows whose vectors differ in length
from the one of smallest id. A null id counts as the largest; equal ids are ordered by vector.
Ties in distance go to the lower entry, so repeated vectors get one code; an entry without
parts stays. Fewer vectors than entries make smaller codebooks. An empty table gives no rows.
Errors beyond 64 bits are held at the limit. Extra columns pass through; those named ``code``
or ``error`` are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgelake.llm.tables import discarded, free_names, stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024.0
_BLOCK = 4096  # rows of a block at most
_BLOCK_BYTES = 4 << 20
_LEAF = 16  # parts in a leaf, about
_LIMB = 40
_MOST = 2**63 - 1


@dataclass
class Codebooks:
    """``books[p]`` has one row of integers per entry; ``dim`` is the vectors' length."""

    dim: int
    books: list[np.ndarray]

    def bounds(self) -> list[tuple[int, int]]:
        return part_bounds(self.dim, len(self.books))

    def sha256(self) -> str:
        numbers = [str(int(x)) for book in self.books for row in book for x in row]
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def part_bounds(dim: int, parts: int) -> list[tuple[int, int]]:
    return [(p * dim // parts, (p + 1) * dim // parts) for p in range(parts)]


def taking_part(df: DataFrame, vector_col: str, scale: float = SCALE) -> DataFrame:
    """Rows whose scaled vectors are whole and finite."""
    bad = F.exists(F.col(vector_col), lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double") * scale) == float("inf")))
    return df.where(F.col(vector_col).isNotNull() & ~F.coalesce(bad, F.lit(True)))


def exact(most: float, width: int) -> bool:
    """Whether doubles hold all sums of squares of doubled differences of such whole numbers."""
    return max(width, 1) * (4 * most) ** 2 < 2.0**52


def integers(values: np.ndarray) -> np.ndarray:
    """Whole numbers as doubles where these compute with them exactly, else as Python integers."""
    if values.dtype != object:
        if exact(float(np.abs(values).max(initial=0.0)), values.shape[1]):
            return values.astype(np.float64)
        out = np.empty(values.shape, object)
        out.reshape(-1)[:] = [int(x) for x in values.reshape(-1)]
        return out
    return values


def fitting(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both of one kind."""
    rows, book = integers(rows), integers(book)
    return (rows, book) if rows.dtype == book.dtype else (_python(rows), _python(book))


def _python(values: np.ndarray) -> np.ndarray:
    if values.dtype == object:
        return values
    out = np.empty(values.shape, object)
    out.reshape(-1)[:] = [int(x) for x in values.reshape(-1)]
    return out


def levels_of(n: int, leaf: int) -> int:
    """Depth of a tree whose leaves hold between ``leaf / 2`` and ``leaf`` of ``n``, one at least."""
    levels = 0
    while n > leaf << levels and n >= 2 << levels:
        levels += 1
    return levels


def _edges(n: int, level: int) -> np.ndarray:
    return np.arange((1 << level) + 1) * n >> level


def tree_order(values: np.ndarray, leaf: int) -> np.ndarray:
    """Order of the rows that puts every node's rows together; halves split the widest side."""
    n, width = values.shape
    order = np.arange(n)
    if not width:
        return order
    for level in range(levels_of(n, leaf)):
        edges = _edges(n, level)
        held = values[order]
        spread = np.maximum.reduceat(held, edges[:-1]) - np.minimum.reduceat(held, edges[:-1])
        widest = np.argmax(spread, axis=1)
        node = np.repeat(np.arange(len(widest)), np.diff(edges))
        order = order[np.lexsort((held[np.arange(n), widest[node]], node))]
    return order


class Tree:
    """Boxes, sums and sizes of the nodes of each level over rows in tree order. A box is given by
    its doubled middle and its width, which are whole numbers."""

    def __init__(self, rows: np.ndarray, leaf: int, sums: bool) -> None:
        self.rows, self.depth = rows, levels_of(len(rows), leaf)
        starts = _edges(len(rows), self.depth)[:-1]
        low, high = (f.reduceat(rows, starts) for f in (np.minimum, np.maximum))
        total = np.add.reduceat(rows, starts) if sums else None
        self.boxes, self.sums = [(low + high, high - low)], [total]
        for _ in range(self.depth):
            low, high = np.minimum(low[::2], low[1::2]), np.maximum(high[::2], high[1::2])
            self.boxes.insert(0, (low + high, high - low))
            self.sums.insert(0, self.sums[0][::2] + self.sums[0][1::2] if sums else None)

    def edges(self, level: int) -> np.ndarray:
        return _edges(len(self.rows), level)


_PAIRS = 1 << 13  # node pairs measured together


def _box_distances(parts: Tree, entries: Tree, at: tuple[int, int], p: np.ndarray, e: np.ndarray):
    """Least and greatest squared distance between the boxes of node pairs, four times each."""
    (p_mid, p_wide), (e_mid, e_wide) = parts.boxes[at[0]], entries.boxes[at[1]]
    least, most = np.empty(len(p), p_mid.dtype), np.empty(len(p), p_mid.dtype)
    for a in range(0, len(p), _PAIRS):
        i, j = p[a : a + _PAIRS], e[a : a + _PAIRS]
        apart, wide = np.abs(p_mid[i] - e_mid[j]), p_wide[i] + e_wide[j]
        least[a : a + _PAIRS] = _squares(np.maximum(apart - wide, 0))
        most[a : a + _PAIRS] = _squares(apart + wide)
    return least, most


def _squares(x: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1) if x.dtype == object else np.einsum("ij,ij->i", x, x)


def dual_walk(parts: Tree, entries: Tree, index: np.ndarray, whole, leaf) -> None:
    """Walk both trees. ``whole(level, nodes, entry)`` is told of nodes assigned to one entry
    each, ``leaf(node, candidates)`` of leaves of parts with the entries that may be nearest;
    ``index`` gives the codebook's number of each entry in tree order."""
    p, e = np.zeros(1, np.int64), np.zeros(1, np.int64)
    at = (0, 0)
    while True:
        least, most = _box_distances(parts, entries, at, p, e)
        new = np.flatnonzero(np.diff(p, prepend=-1))
        bound = np.minimum.reduceat(most, new)
        kept = least <= np.repeat(bound, np.diff(np.append(new, len(p))))
        p, e = p[kept], e[kept]
        new = np.flatnonzero(np.diff(p, prepend=-1))
        alone = np.zeros(len(p), bool)
        alone[new] = np.diff(np.append(new, len(p))) == 1
        edges = entries.edges(at[1])
        alone &= edges[e + 1] - edges[e] == 1
        if alone.any():
            whole(at[0], p[alone], index[edges[e[alone]]])
            p, e = p[~alone], e[~alone]
        deeper = at[0] < parts.depth, at[1] < entries.depth
        if not len(p) or not any(deeper):
            break
        if deeper[1]:
            p, e = np.repeat(p, 2), np.repeat(e * 2, 2)
            e[1::2] += 1
        if deeper[0]:
            # A node's pairs stay together: all of its left half, then all of its right one.
            new = np.flatnonzero(np.diff(p, prepend=-1))
            sizes = np.diff(np.append(new, len(p)))
            place = np.arange(len(p)) - np.repeat(new, sizes)
            left = np.repeat(new * 2, sizes) + place
            both_p, both_e = np.empty(2 * len(p), np.int64), np.empty(2 * len(p), np.int64)
            right = left + np.repeat(sizes, sizes)
            both_p[left], both_p[right] = 2 * p, 2 * p + 1
            both_e[left] = both_e[right] = e
            p, e = both_p, both_e
        at = at[0] + deeper[0], at[1] + deeper[1]
    edges = entries.edges(at[1])
    # The entries of every leaf's surviving nodes, one after the other.
    sizes = edges[e + 1] - edges[e]
    ends = np.cumsum(sizes)
    found = index[np.arange(sizes.sum()) + np.repeat(edges[e] - (ends - sizes), sizes)]
    new = np.flatnonzero(np.diff(p, prepend=-1))
    begins = (ends - sizes)[new]
    for node, a, b in zip(p[new].tolist(), begins.tolist(), [*begins[1:].tolist(), len(found)]):
        leaf(node, np.sort(found[a:b]))


def _entry_tree(book: np.ndarray) -> tuple[Tree, np.ndarray]:
    order = tree_order(book, 1)
    return Tree(book[order], 1, False), order


def _distances(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole numbers."""
    if rows.dtype == object:
        gap = rows[:, None, :] - entries[None, :, :]
        return (gap * gap).sum(axis=2)
    return _squares(rows)[:, None] - 2 * (rows @ entries.T) + _squares(entries)[None, :]


def nearest(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each row; ties go to the lower entry."""
    rows, book = fitting(rows, book)
    order = tree_order(rows, _LEAF)
    held = rows[order]
    tree, (entries, index) = Tree(held, _LEAF, False), _entry_tree(book)
    found = np.zeros(len(rows), np.int64)

    def whole(level: int, nodes: np.ndarray, entry: np.ndarray) -> None:
        edges = tree.edges(level)
        for node, k in zip(nodes, entry):
            found[edges[node] : edges[node + 1]] = k

    def leaf(node: int, candidates: np.ndarray) -> None:
        a, b = tree.edges(tree.depth)[node : node + 2]
        found[a:b] = candidates[_distances(held[a:b], book[candidates]).argmin(axis=1)]

    dual_walk(tree, entries, index, whole, leaf)
    entry = np.empty_like(found)
    entry[order] = found
    return entry, _squares(rows - book[entry])


def add_sums(held: np.ndarray, book: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Add rows in tree order to the sums of their entries; returns the sums, which become
    Python integers with the first rows that need it."""
    held, book = fitting(held, book)
    if held.dtype == object:
        sums = _python(sums)
    tree, (entries, index) = Tree(held, _LEAF, True), _entry_tree(book)

    def whole(level: int, nodes: np.ndarray, entry: np.ndarray) -> None:
        np.add.at(sums, entry, tree.sums[level][nodes].astype(sums.dtype))
        np.add.at(counts, entry, np.diff(tree.edges(level))[nodes])

    def leaf(node: int, candidates: np.ndarray) -> None:
        a, b = tree.edges(tree.depth)[node : node + 2]
        entry = candidates[_distances(held[a:b], book[candidates]).argmin(axis=1)]
        np.add.at(sums, entry, held[a:b].astype(sums.dtype))
        np.add.at(counts, entry, 1)

    dual_walk(tree, entries, index, whole, leaf)
    return sums


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim) if dim else np.zeros((len(column), 0))


def _scaled(column: pa.Array, dim: int, scale: float) -> np.ndarray:
    return np.floor(_matrix(column, dim) * scale)


def _blocks(vectors: DataFrame, dim: int, parts: int, scale: float) -> DataFrame:
    """Blocks of scaled vectors, each part flattened in the order of its tree."""
    most = max(64, min(_BLOCK, _BLOCK_BYTES // (8 * max(1, dim))))
    kind = pa.list_(pa.list_(pa.float64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, most):
                rows = _scaled(batch.column(0).slice(a, most), dim, scale)
                found = []
                for low, high in part_bounds(dim, parts):
                    held = np.ascontiguousarray(rows[:, low:high])
                    found.append(held[tree_order(held, _LEAF)].ravel())
                offsets = np.cumsum([0, *(len(f) for f in found)])
                inner = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(found)))
                outer = pa.ListArray.from_arrays(pa.array([0, parts], pa.int32()), inner)
                yield pa.RecordBatch.from_arrays([pa.array([len(rows)]), outer.cast(kind)], names=["n", "parts"])

    return vectors.mapInArrow(run, "n bigint, parts array<array<double>>")


def _round(blocks: DataFrame, books: Codebooks) -> list[np.ndarray]:
    """The codebooks after one round."""
    held = blocks.sparkSession.sparkContext.broadcast(books)  # entries * dim integers
    names = ["part", "entry", "place", "limb", "value"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = held.value.books
        sums = [np.zeros(b.shape, np.int64) for b in now]
        counts = [np.zeros(len(b), np.int64) for b in now]
        for batch in batches:
            for n, values in zip(batch.column(0).to_pylist(), batch.column(1)):
                for p, book in enumerate(now):
                    rows = values.values[p].values.to_numpy(zero_copy_only=False).reshape(n, book.shape[1])
                    sums[p] = add_sums(rows, book, sums[p], counts[p])
        for p, (total, count) in enumerate(zip(sums, counts)):
            used = np.flatnonzero(count)
            # The count stands at place -1.
            rest = np.concatenate([_python(count[used, None]) if total.dtype == object else count[used, None], total[used]], axis=1)
            entry = np.repeat(used, rest.shape[1])
            place = np.tile(np.arange(rest.shape[1]) - 1, len(used))
            rest, limb = rest.ravel(), 0
            while len(rest):
                if rest.dtype == object:
                    value = np.array([int(x) & ((1 << _LIMB) - 1) for x in rest], np.int64)
                    left = np.array([int(x) >> _LIMB for x in rest], object)
                    last = np.array([x in (0, -1) for x in left], bool)
                    value[last] += np.array([int(x) << _LIMB for x in left[last]], np.int64)
                else:
                    value, left, last = rest, rest, np.ones(len(rest), bool)
                columns = [np.full(len(value), p), entry, place, np.full(len(value), limb), value]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=names)
                rest, entry, place, limb = left[~last], entry[~last], place[~last], limb + 1

    found = blocks.mapInArrow(run, ", ".join(f"{n} bigint" for n in names))
    found = found.groupBy(*names[:4]).agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("value"))
    totals: dict[tuple[int, int, int], int] = {}
    for r in found.collect():  # one row per codebook number and limb
        key = (r.part, r.entry, r.place)
        totals[key] = totals.get(key, 0) + (int(r.value) << (_LIMB * r.limb))
    held.unpersist()
    new = [b.astype(object) for b in books.books]
    for (part, entry, place), total in totals.items():
        if place >= 0:
            new[part][entry, place] = total // totals[part, entry, -1]
    return [_narrow(b) for b in new]


def _narrow(book: np.ndarray) -> np.ndarray:
    """A codebook of Python integers in 64 bits, if it fits."""
    return book.astype(np.int64) if all(abs(x) < 2**62 for x in book.ravel()) else book


def fit(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: float = SCALE,
) -> Codebooks:
    """Codebooks of all vectors of ``df``, at most 256 entries each."""
    if not 1 <= entries <= 256:
        raise ValueError("codes have two hexadecimal digits: between 1 and 256 entries")
    kept = taking_part(df, vector_col, scale).select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    first = kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(1).collect()
    if not first:
        return Codebooks(-1, [np.zeros((0, 0), np.int64)] * parts)
    dim = len(first[0].v)
    kept = kept.where(F.size("v") == dim)
    heads = kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    rows = np.floor(np.array([r.v for r in heads], np.float64).reshape(len(heads), dim) * scale)
    books = Codebooks(dim, [_narrow(_python(rows[:, a:b])) for a, b in part_bounds(dim, parts)])
    blocks = stored(_blocks(kept.select("v"), dim, parts, scale), "vector-blocks")
    for _ in range(rounds):
        books = Codebooks(dim, _round(blocks, books))
    discarded(blocks)
    return books


def encode(df: DataFrame, books: Codebooks, vector_col: str = "embedding", scale: float = SCALE) -> DataFrame:
    """Rows that take part, with ``code`` and ``error``, the squared distance to what it stands for."""
    held = df.sparkSession.sparkContext.broadcast(books)
    columns = [c for c in df.columns if c not in ("code", "error")]
    vector, = free_names(columns, "vector")
    kept = taking_part(df, vector_col, scale).where(F.size(vector_col) == books.dim)
    schema = T.StructType(list(df.select(*columns).schema)).add("code", "string").add("error", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = held.value
        for whole in batches:
            for a in range(0, whole.num_rows, _BLOCK):
                batch = whole.slice(a, _BLOCK)
                rows = _scaled(batch.column(vector), now.dim, scale)
                codes, errors = [], np.zeros(len(rows), object)
                for book, (low, high) in zip(now.books, now.bounds()):
                    entry, distance = nearest(np.ascontiguousarray(rows[:, low:high]), book)
                    codes.append(entry)
                    errors += _python(distance[:, None])[:, 0]
                text = [bytes(c).hex() for c in np.stack(codes, axis=1).astype(np.uint8)]
                arrays = [batch.column(c) for c in columns]
                arrays += [pa.array(text, pa.string()), pa.array([min(int(x), _MOST) for x in errors], pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return kept.select(*columns, F.col(vector_col).alias(vector)).mapInArrow(run, schema)


_SALTS = 16


def with_label_errors(coded: DataFrame, label_col: str = "label") -> DataFrame:
    """``coded`` with ``label_error``, the errors of equal labels added up, nulls together. The
    sums of labels are repeated per salt, so that a label with a third of all rows meets
    them in many tasks."""
    label, salt = free_names(coded.columns, "of_label", "salt")
    total = F.least(F.sum(F.col("error").cast("decimal(20,0)")), F.lit(_MOST)).cast("bigint").alias("label_error")
    sums = coded.groupBy(F.col(label_col).alias(label)).agg(total)
    sums = sums.withColumn(salt, F.explode(F.array(*map(F.lit, range(_SALTS)))))
    dealt = coded.withColumn(salt, F.pmod(F.xxhash64(*coded.columns), F.lit(_SALTS)).cast("int"))
    dealt, sums = dealt.alias("c"), sums.alias("s")
    same = F.col(f"c.{label_col}").eqNullSafe(F.col(f"s.{label}")) & (F.col(f"c.{salt}") == F.col(f"s.{salt}"))
    return dealt.join(sums, same).select(*(f"c.{c}" for c in coded.columns if c != "label_error"), "s.label_error")
