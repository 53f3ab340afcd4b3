"""SentencePiece encoding and decoding, with a max-plus scan for giant documents.

Ordinary texts are encoded whole. A giant text is cut into chunks of ``chunk_chars``. The
state at a cut is the piece that covers the character before it, and a chunk's transfer
matrix holds, for each state at its left and right cut, the best weight of the pieces
between. Matrices multiply in the max-plus semiring, which is associative; prefix and suffix
products meet at every cut and name the one piece there that lies on the best path. Each
chunk then encodes on its own what lies between the pieces at its two cuts.

For unigram models the weights are the pieces' scores. For merge (BPE) models a path is
allowed, with weight 0, if every two neighbouring pieces are what merging their joined text
gives, else it weighs minus infinity: merges in one piece do not see beyond its neighbours,
so exactly one path through a text is allowed, and it is the encoding.

Where two neighbouring characters stand side by side in no piece, every path has a cut. So
texts fall into short segments, whose encodings are remembered, and a chunk's matrix needs
only its first and last segment: what lies between adds the same weight to every entry.

Supported are models with identity normalisation that keep white space, with or without
byte fallback and dummy prefix; others are refused. Encoding and decoding give back every text
but those with U+2581, which the model cannot tell from a space.

Defined cases. A null text has null pieces and null decoded text, an empty one no pieces.
Repeated rows are treated alike; other columns pass through under any name, but those named like a
result column are replaced. Of pieces of one score the leftmost is merged first. An empty table gives no
rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgelake.llm.tables import free_names, stored
from forgelake.llm.textblocks import slices

CHUNK_CHARS = 1 << 16
SPACE = "▁"
_REMEMBERED = 24 << 20  # bytes of remembered segments, about; as many more until they fall out of use
_FITS = 100_000
_DECODED = 256  # rows decoded together
_UNIT = 1 << 20  # bytes of text encoded together
_TABLE = 1 << 20


@dataclass
class Vocabulary:
    """Pieces that text can be made of, with ids and scores."""

    ids: dict[str, int]
    scores: dict[str, float]
    raw: list[bytes]  # what each id decodes to
    bytes_at: list[int] | None  # ids of the 256 bytes, or None without byte fallback
    unknown: int
    merges: bool  # a merge model, else unigram
    prefix: bool
    longest: int = 0
    joined: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))

    def __post_init__(self) -> None:
        self.longest = max(map(len, self.ids), default=1)
        # Hashed set of neighbouring characters within pieces; a collision only joins more.
        pairs = np.array([[ord(a), ord(b)] for p in self.ids for a, b in zip(p, p[1:])], np.uint32).reshape(-1, 2)
        self.joined = np.zeros(_TABLE, bool)
        self.joined[_pair_slot(pairs[:, 0], pairs[:, 1])] = True


def _pair_slot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint32(0x9E3779B1) ^ b * np.uint32(0x85EBCA6B)
    return (x ^ (x >> np.uint32(15))) % np.uint32(_TABLE)


def load(path: str) -> Vocabulary:
    """Read a model file on the driver; the vocabulary's size is the model's."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    norm, kinds = model.normalizer_spec, pb.ModelProto.SentencePiece
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("only models that keep text as it is are supported")
    if model.trainer_spec.model_type not in (1, 2):
        raise ValueError("only unigram and merge models are supported")
    plain = {i: p for i, p in enumerate(model.pieces) if p.type in (kinds.NORMAL, kinds.USER_DEFINED)}
    at = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
    raw = []
    for i, p in enumerate(model.pieces):
        if p.type == kinds.BYTE:
            raw.append(bytes([int(p.piece[3:5], 16)]))
        elif i in plain:
            raw.append(p.piece.replace(SPACE, " ").encode())
        else:
            raw.append(" ⁇ ".encode() if p.type == kinds.UNKNOWN else b"")
    return Vocabulary(
        {p.piece: i for i, p in plain.items()},
        {p.piece: p.score for p in plain.values()},
        raw,
        [at[b] for b in range(256)] if len(at) == 256 else None,
        next(i for i, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN),
        model.trainer_spec.model_type == 2,
        norm.add_dummy_prefix,
    )


class Encoder:
    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        # Segments in use lately, and those of the generation before.
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.held = 0
        self.fits: dict[tuple[str, str], bool] = {}
        self.floor = min(vocabulary.scores.values(), default=0.0) - 10

    # Pieces of a segment, as text.

    def split(self, text: str) -> list[str]:
        if self.v.merges:
            return self._merge(text) if len(text) <= 40 else self._merge_long(text)
        return self._best_path(text)

    def _merge(self, text: str) -> list[str]:
        """Join the neighbours of highest score, the leftmost of equals, until none is left."""
        parts, score, none = list(text), self.v.scores.get, -np.inf
        joined = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while joined:
            best = max(joined)
            if best == none:
                break
            at = joined.index(best)
            piece = parts[at] + parts[at + 1]
            parts[at : at + 2] = [piece]
            del joined[at]
            if at:
                joined[at - 1] = score(parts[at - 1] + piece, none)
            if at < len(joined):
                joined[at] = score(piece + parts[at + 1], none)
        return parts

    def _merge_long(self, text: str) -> list[str]:
        """The same with a heap."""
        parts, score = list(text), self.v.scores.get
        right, left = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str, str]] = []

        def offer(a: int, b: int) -> None:
            s = score(parts[a] + parts[b])
            if s is not None:
                heapq.heappush(heap, (-s, a, parts[a], parts[b]))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, a, x, y = heapq.heappop(heap)
            b = right[a]
            if b >= len(parts) or parts[a] != x or parts[b] != y:
                continue
            parts[a], parts[b] = x + y, ""
            right[a] = right[b]
            if right[a] < len(parts):
                left[right[a]] = a
                offer(a, right[a])
            if left[a] >= 0:
                offer(left[a], a)
        return [p for p in parts if p]

    def _best_path(self, text: str) -> list[str]:
        best: list[tuple[float, int]] = [(0.0, 0)] + [(-np.inf, 0)] * len(text)
        for i in range(len(text)):
            for piece in self.at(text, i):
                total = best[i][0] + self.weight(piece)
                if total > best[i + len(piece)][0]:
                    best[i + len(piece)] = total, i
        out, end = [], len(text)
        while end:
            out.append(text[best[end][1] : end])
            end = best[end][1]
        return out[::-1]

    def ids(self, text: str) -> list[int]:
        """Ids of any text without dummy prefix, segment by segment."""
        out: list[int] = []
        known = self.known
        bounds = [0, *self.cuts(text).tolist(), len(text)] if text else []
        for segment in [text[a:b] for a, b in zip(bounds, bounds[1:])]:
            ids = known.get(segment)
            if ids is None:
                ids = self.older.get(segment)
                if ids is None:
                    ids = tuple([x for p in self.split(segment) for x in self.piece_ids(p)])
                if self.held >= _REMEMBERED:
                    self.older, self.known, self.held = known, {}, 0
                    known = self.known
                known[segment] = ids
                self.held += 220 + len(segment) + 8 * len(ids)
            out += ids
        return out

    def piece_ids(self, piece: str) -> list[int]:
        if piece in self.v.ids:
            return [self.v.ids[piece]]
        if self.v.bytes_at:
            return [self.v.bytes_at[b] for b in piece.encode()]
        return [self.v.unknown]

    def cuts(self, text: str) -> np.ndarray:
        """Places inside the text where every path is cut."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        return np.flatnonzero(~self.v.joined[_pair_slot(points[:-1], points[1:])]) + 1

    # The lattice: a state is a piece with its place.

    def at(self, text: str, i: int) -> list[str]:
        """Pieces that begin at ``i``; a character in no piece stands for itself."""
        found = [text[i:j] for j in range(i + 1, min(len(text), i + self.v.longest) + 1) if text[i:j] in self.v.ids]
        if not found or len(found[0]) > 1:
            found.insert(0, text[i])
        if self.v.merges:
            found = [p for p in found if len(p) == 1 or self.split(p) == [p]]
        return found

    def weight(self, piece: str) -> float:
        return 0.0 if self.v.merges else self.v.scores.get(piece, self.floor)

    def neighbours(self, a: str, b: str) -> bool:
        if not self.v.merges or not a:  # nothing stands before a sure cut
            return True
        fits = self.fits.get((a, b))
        if fits is None:
            if len(self.fits) >= _FITS:
                self.fits.clear()
            fits = self.fits[a, b] = self.split(a + b) == [a, b]
        return fits

    def states(self, text: str, cut: int) -> list[tuple[int, str]]:
        """Pieces that cover the character before ``cut``, with their starts. No piece reaches
        over a place where every path is cut."""
        low = max(0, cut - self.v.longest)
        inside = self.cuts(text[low : cut + self.v.longest]) + low
        a = max([low, *inside[inside < cut].tolist()])
        b = min([len(text), *inside[inside >= cut].tolist()])
        return [(i, p) for i in range(a, cut) for p in self.at(text[:b], i) if i + len(p) >= cut]

    def paths(self, text: str, begins: list[tuple[int, str]], ends: list[tuple[int, str]]) -> np.ndarray:
        """Best weight from each of ``begins`` (not counted) to each of ``ends`` (counted)."""
        width = len(begins)
        alive: dict[int, dict[tuple[int, str], np.ndarray]] = {}
        for n, (i, p) in enumerate(begins):
            row = np.full(width, -np.inf)
            row[n] = 0.0
            alive.setdefault(i + len(p), {})[i, p] = row
        out = np.full((width, len(ends)), -np.inf)
        for n, end in enumerate(ends):
            if end in begins:
                out[begins.index(end), n] = 0.0
        last = max((i for i, _ in ends), default=0)
        wanted = {end: n for n, end in enumerate(ends)}
        for i in range(min(alive, default=0), last + 1):
            before = alive.pop(i, None)
            if not before:
                continue
            for piece in self.at(text, i):
                rows = [row for (_, p), row in before.items() if self.neighbours(p, piece)]
                if rows:
                    row = np.max(rows, axis=0) + self.weight(piece)
                    alive.setdefault(i + len(piece), {})[i, piece] = row
                    if (i, piece) in wanted:
                        out[:, wanted[i, piece]] = np.maximum(out[:, wanted[i, piece]], row)
        return out


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of two matrices in the max-plus semiring."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1) if a.size and b.size else np.full((len(a), b.shape[1]), -np.inf)


def transfer(encoder: Encoder, text: str, left: int, right: int, first: bool, last: bool):
    """States at the cuts ``left`` and ``right`` of ``text``, which has margins around them,
    and the matrix between. The first and the last chunk have one outer state."""
    begins = [] if first else encoder.states(text, left)
    ends = [] if last else encoder.states(text, right)
    sure = encoder.cuts(text)
    sure = sure[(sure > left + encoder.v.longest) & (sure < right - encoder.v.longest)].tolist()

    def between(a: int, b: int, x, y) -> np.ndarray:
        """From states ``x`` or the sure cut ``a`` to states ``y`` or the sure cut ``b``."""
        part = text[a:b]
        x = [(i - a, p) for i, p in x] if x is not None else [(0, "")]
        if y is not None:
            return encoder.paths(part, x, [(i - a, p) for i, p in y])
        final = [(i, p) for i in range(max(0, len(part) - encoder.v.longest), len(part)) for p in encoder.at(part, i) if i + len(p) == len(part)]
        done = [(n, s) for n, s in enumerate(x) if s[0] + len(s[1]) == len(part)]
        out = encoder.paths(part, x, final).max(axis=1, keepdims=True) if final else np.full((len(x), 1), -np.inf)
        for n, _ in done:
            out[n] = max(out[n, 0], 0.0)
        return out

    low = max(0, left - encoder.v.longest)
    stop = len(text) if last else min(len(text), right + encoder.v.longest)
    if sure:
        head = np.zeros((1, 1)) if first else between(low, sure[0], begins, None)
        tail = np.zeros((1, 1)) if last else between(sure[-1], stop, None, ends)
        matrix = max_plus(head, tail)
    else:
        matrix = between(0 if first else low, stop, None if first else begins, None if last else ends)
    return begins, ends, matrix


def chosen_states(matrices: list[np.ndarray]) -> list[int]:
    """Index of the state on the best path at each inner cut, from products of all matrices
    before it and all after it; both scans double their reach in each step."""

    def scan(values: list[np.ndarray], flip: bool) -> list[np.ndarray]:
        reach = 1
        while reach < len(values):
            values = [
                values[i] if i < reach else max_plus(*((values[i], values[i - reach]) if flip else (values[i - reach], values[i])))
                for i in range(len(values))
            ]
            reach *= 2
        return values

    before = scan(matrices, False)
    after = scan(matrices[::-1], True)[::-1]
    return [int((before[i][0] + after[i + 1][:, 0]).argmax()) for i in range(len(matrices) - 1)]


_CHUNKS = "key bigint, chunk int, chunks int, margin int, body int, text string"


def _chunked(giants: DataFrame, chunk_chars: int, margin: int) -> DataFrame:
    """Chunks with margins of normalised giant texts."""
    size = F.length("text")
    n = F.ceil(size / chunk_chars).cast("int")
    rows = giants.select("key", "text", n.alias("chunks"), F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk"))
    start = F.col("chunk") * chunk_chars
    before = F.least(start, F.lit(margin))
    body = F.least(F.lit(chunk_chars), F.length("text") - start)
    text = F.substr("text", start - before + 1, before + body + margin)
    return rows.select("key", "chunk", "chunks", before.alias("margin"), body.alias("body"), text.alias("text"))


def encode(
    docs: DataFrame,
    vocabulary: Vocabulary,
    text_col: str = "text",
    ids_col: str = "token_ids",
    chunk_chars: int = CHUNK_CHARS,
    decoded_col: str | None = None,
) -> DataFrame:
    """``docs`` with the ids of their texts and, as ``decoded_col``, the texts of these ids: the
    worker that encodes a text decodes it too."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(vocabulary)
    added = [ids_col] if decoded_col is None else [ids_col, decoded_col]
    columns = [c for c in docs.columns if c not in added]
    size = F.length(text_col)
    ordinary = docs.select(*columns).where(size.isNull() | (size <= chunk_chars))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in ordinary.schema]).add(ids_col, T.ArrayType(T.IntegerType()))
    if decoded_col is not None:
        schema = schema.add(decoded_col, "string")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(held.value)
        start = SPACE if encoder.v.prefix else ""
        raw = _raw_pieces(held.value) if decoded_col is not None else None
        for batch in slices(batches, text_col, _UNIT):
            found = [
                None if t is None else encoder.ids(start + t.replace(" ", SPACE)) if t else []
                for t in batch.column(text_col).to_pylist()
            ]
            arrays = [*batch.columns, pa.array(found, pa.list_(pa.int32()))]
            if raw is not None:
                arrays.append(_decoded(arrays[-1], raw, encoder.v.prefix))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    small = ordinary.mapInArrow(whole, schema)

    # Giant texts: the rows are stored once under a key, as their order decides it.
    key, = free_names([*docs.columns, *added], "key")
    giants = docs.select(*columns).where(size > chunk_chars).withColumn(key, F.monotonically_increasing_id())
    giants = stored(giants, "giant-texts")
    if giants.isEmpty():
        return small
    normal = F.translate(F.col(text_col), " ", SPACE)
    texts = giants.select(F.col(key).alias("key"), (F.concat(F.lit(SPACE), normal) if vocabulary.prefix else normal).alias("text"))
    # Twice the longest piece: a state at a cut may begin or end that far away, and its
    # neighbours as well.
    spread = _chunked(texts, chunk_chars, 2 * vocabulary.longest).repartition("key", "chunk")
    chunks = stored(spread, "chunks")
    states = T.ArrayType(T.StructType().add("start", "integer").add("piece", "string"))
    entry = pa.list_(pa.struct([("start", pa.int32()), ("piece", pa.string())]))
    matrix_schema = T.StructType().add("key", "long").add("chunk", "integer").add("begins", states).add("ends", states)
    matrix_schema = matrix_schema.add("matrix", T.ArrayType(T.DoubleType()))

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(held.value)
        kinds = [pa.int64(), pa.int32(), entry, entry, pa.list_(pa.float64())]
        for batch in batches:
            for row in batch.to_pylist():
                left, right = row["margin"], row["margin"] + row["body"]
                first, last = row["chunk"] == 0, row["chunk"] == row["chunks"] - 1
                begins, ends, matrix = transfer(encoder, row["text"], left, right, first, last)
                at = [
                    [{"start": i - cut, "piece": p} for i, p in found] for cut, found in ((left, begins), (right, ends))
                ]
                values = [[row["key"]], [row["chunk"]], [at[0]], [at[1]], [matrix.ravel().tolist()]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, k) for v, k in zip(values, kinds)], names=matrix_schema.names
                )

    def combine(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
        found = chosen_states([np.array(r["matrix"]).reshape(max(1, len(r["begins"])), -1) for r in rows])
        # What a chunk encodes begins and ends behind the chosen pieces, counted from its cuts.
        behind = [r["ends"][s]["start"] + len(r["ends"][s]["piece"]) for r, s in zip(rows, found)]
        return pa.table(
            {
                "key": pa.array([r["key"] for r in rows], pa.int64()),
                "chunk": pa.array([r["chunk"] for r in rows], pa.int32()),
                "skip": pa.array([0, *behind], pa.int32()),
                "over": pa.array([*behind, 0], pa.int32()),
            }
        )

    spans = chunks.mapInArrow(matrices, matrix_schema).groupBy("key").applyInArrow(combine, "key bigint, chunk int, skip int, over int")
    work = chunks.join(spans, ["key", "chunk"])

    def backtrace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(held.value)
        for batch in batches:
            for row in batch.select(["key", "chunk", "margin", "body", "skip", "over", "text"]).to_pylist():
                a = row["margin"] + row["skip"]
                b = row["margin"] + row["body"] + row["over"]
                ids = pa.array([encoder.ids(row["text"][a:b])], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array([row["key"]]), pa.array([row["chunk"]], pa.int32()), ids], names=["key", "chunk", "ids"])

    parts = work.mapInArrow(backtrace, "key bigint, chunk int, ids array<int>")
    joined = parts.groupBy(F.col("key").alias(key)).agg(F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("parts"))
    joined = joined.select(key, F.flatten(F.col("parts.ids")).alias(ids_col))
    large = giants.join(joined, key).select(*columns, ids_col)
    return small.unionByName(large if decoded_col is None else decode(large, vocabulary, ids_col, decoded_col))


def _raw_pieces(vocabulary: Vocabulary) -> pa.Array:
    return pa.array(vocabulary.raw, pa.large_binary())


def _decoded(column: pa.Array, raw: pa.Array, drop: bool) -> pa.Array:
    """The texts of lists of ids. The pieces of all rows in a row: their bytes are the texts."""
    texts = []
    taken = raw.take(column.flatten())
    data = (taken.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
    ends = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1) if len(taken) else np.zeros(1, np.int64)
    known = column.is_valid().to_numpy(zero_copy_only=False)
    sizes = np.where(known, np.diff(column.offsets.to_numpy()), 0)
    last = np.cumsum(sizes)
    for ok, a, b in zip(known.tolist(), ends[last - sizes].tolist(), ends[last].tolist()):
        text = data[a:b].decode("utf-8", "replace") if ok else None
        texts.append(text[1:] if text and drop and text[0] == " " else text)
    return pa.array(texts, pa.string())


def decode(df: DataFrame, vocabulary: Vocabulary, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the text of its ids; ids outside the vocabulary are an error."""
    held = df.sparkSession.sparkContext.broadcast(vocabulary)
    kept = df.select(*[c for c in df.columns if c != out_col])
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in kept.schema]).add(out_col, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = _raw_pieces(held.value)
        for whole in batches:
            for a in range(0, whole.num_rows, _DECODED):
                batch = whole.slice(a, _DECODED)
                arrays = [*batch.columns, _decoded(batch.column(ids_col), raw, held.value.prefix)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return kept.mapInArrow(run, schema)
