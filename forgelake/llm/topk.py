"""Exact top-k search by inner product over integer vectors.

Queries are grouped in blocks and candidates in tiles; every block meets every tile in one
task, which multiplies the two matrices piece by piece and keeps each query's ``k`` best. The
lists of the tiles are merged in a tree of fixed fan-in, so no task sees more than
``FAN_IN * k`` rows of a query.

Products are taken in 32-bit or 64-bit floats if the largest possible sum is exact in them,
else in Python integers; scores beyond 64 bits are held at its limits.

Defined cases. A vector that is null, or holds a null or non-finite component, and a row
without id take no part. Vectors meet only vectors of their own length. Ties go to the
smaller id. A query never meets rows of its own id; of repeated query rows the smallest
vector counts, repeated candidates each count. Empty tables give no rows, and extra columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERIES = 8192  # in a block
CANDIDATES = 65_536  # in a tile at most
TILE_BYTES = 64 << 20  # of doubles in a tile at most, but for 1,024 vectors
TILES_PER_CORE = 4  # smaller tables get smaller tiles, for all cores to have work
FAN_IN = 32
_PIECE = 1024, 4096  # queries and candidates of one matrix product


def quantised(df: DataFrame, id_col: str, vector_col: str, scale: float = 256.0) -> DataFrame:
    """``id, v, dim`` with v = floor(scale * x) as doubles, of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.where(F.col(id_col).isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(True)))
    # floor() of a double would be a bigint; rounding down by hand keeps large values.
    down = F.transform(v, lambda x: F.when(F.abs(x * scale) < 2.0**52, F.floor(x * scale).cast("double")).otherwise(x * scale))
    return rows.select(F.col(id_col).cast("bigint").alias("id"), down.alias("v"), F.size(vector_col).alias("dim"))


def top_k(queries: DataFrame, candidates: DataFrame, k: int, query_block: int = QUERIES, tile_rows: int = CANDIDATES) -> DataFrame:
    """``query_id, rank, vec_id, score`` of two frames from ``quantised``."""
    spark = queries.sparkSession
    queries = queries.groupBy("id").agg(F.min(F.struct("dim", "v")).alias("q")).select("id", "q.dim", "q.v")
    n_queries = queries.count()
    n_rows, dim = candidates.agg(F.count(F.lit(1)), F.max("dim")).first()
    tile_rows = min(tile_rows, max(1024, TILE_BYTES // (8 * max(1, dim or 1))))
    blocks = max(1, -(-n_queries // query_block))
    spread = -(-n_rows // (TILES_PER_CORE * spark.sparkContext.defaultParallelism))
    tiles = max(1, -(-n_rows // max(1024, min(tile_rows, spread))))
    # The vector joins the id in the hash, so that rows of one id are spread too.
    dealt = candidates.withColumn("tile", F.pmod(F.xxhash64("id", "v", F.monotonically_increasing_id()), F.lit(tiles)))
    right = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    left = queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    left = left.withColumn("tile", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(tiles - 1).cast("bigint"))))
    # Both sides may stem from one table: other names keep their columns apart.
    left = left.select(*(F.col(c).alias(f"q_{c}") for c in left.columns))
    keys = ["dim", "block", "tile"]

    def run(key: tuple[pa.Scalar, ...], q: pa.Table, c: pa.Table) -> pa.Table:
        return _tile(q, c, key[0].as_py(), key[2].as_py(), k)

    found = left.groupBy(*(f"q_{c}" for c in keys)).cogroup(right.groupBy(*keys)).applyInArrow(
        run, "query_id bigint, vec_id bigint, score bigint, part bigint"
    )
    return merged(found, tiles, k)


def _matrix(table: pa.Table, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids in ascending order and their vectors."""
    ids = table.column("id").to_numpy()
    values = table.column("v").combine_chunks()
    flat = values.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dim)
    order = np.argsort(ids, kind="stable")
    return ids[order], flat[order]


def _tile(q: pa.Table, c: pa.Table, dim: int, part: int, k: int) -> pa.Table:
    schema = pa.schema([(n, pa.int64()) for n in ("query_id", "vec_id", "score", "part")])
    if not q.num_rows or not c.num_rows:
        return schema.empty_table()
    q_ids, q_values = _matrix(q.rename_columns([c[2:] for c in q.column_names]), dim)
    c_ids, c_values = _matrix(c, dim)
    most = max(1.0, dim * float(np.abs(q_values).max(initial=0)) * float(np.abs(c_values).max(initial=0)))
    kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else object
    if kind is object:
        q_values, c_values = (np.array([[int(x) for x in r] for r in m], object).reshape(m.shape) for m in (q_values, c_values))
    else:
        q_values, c_values = q_values.astype(kind), c_values.astype(kind)
    out = []
    for a in range(0, len(q_ids), _PIECE[0]):
        ids = q_ids[a : a + _PIECE[0]]
        best_score = np.zeros((len(ids), 0), np.int64)
        best_id, held = best_score.copy(), np.zeros((len(ids), 0), bool)
        for b in range(0, len(c_ids), _PIECE[1]):
            product = q_values[a : a + _PIECE[0]] @ c_values[b : b + _PIECE[1]].T
            if kind is object:
                product = np.clip(product, -(2**63), 2**63 - 1)
            vec = np.broadcast_to(c_ids[b : b + _PIECE[1]], product.shape)
            best_score, best_id, held = _select(
                np.concatenate([best_score, product.astype(np.int64)], axis=1),
                np.concatenate([best_id, vec], axis=1),
                np.concatenate([held, vec != ids[:, None]], axis=1),
                k,
            )
        row, col = np.nonzero(held)
        out.append(np.stack([ids[row], best_id[row, col], best_score[row, col], np.full(len(row), part)]))
    return pa.table([pa.array(x) for x in np.concatenate(out, axis=1)], schema=schema)


def _select(score: np.ndarray, ids: np.ndarray, valid: np.ndarray, k: int):
    """Per row the ``k`` valid entries of highest score, then smallest id: whatever reaches
    the k-th score is sorted, the rest is not."""
    low = np.iinfo(np.int64).min
    ranked = np.where(valid, score, low)
    if score.shape[1] <= k:
        return score, ids, valid
    kth = np.partition(ranked, -k, axis=1)[:, -k]
    row, col = np.nonzero(valid & (ranked >= kth[:, None]))
    order = np.lexsort((ids[row, col], -score[row, col].astype(object) if low in ranked[row, col] else -score[row, col], row))
    row, col = row[order], col[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    row, col, place = (x[place < k] for x in (row, col, place))
    shape = (len(score), k)
    new_score, new_ids, new_valid = np.zeros(shape, np.int64), np.zeros(shape, np.int64), np.zeros(shape, bool)
    new_score[row, place], new_ids[row, place], new_valid[row, place] = score[row, col], ids[row, col], True
    return new_score, new_ids, new_valid


def merged(lists: DataFrame, parts: int, k: int) -> DataFrame:
    """Best ``k`` of each query from lists with ``part`` in [0, parts), in a tree."""
    best = [F.col("score").desc(), F.col("vec_id")]
    while parts > FAN_IN:
        parts = -(-parts // FAN_IN)
        group = F.floor(F.col("part") / FAN_IN)
        window = Window.partitionBy("query_id", "part").orderBy(*best)
        lists = lists.withColumn("part", group).withColumn("rank", F.row_number().over(window))
        lists = lists.where(F.col("rank") <= k).drop("rank")
    ranked = lists.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*best)))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
