"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned for
in the token windows of the training texts.

A benchmark item contributes every window of ``window`` consecutive words; an item of fewer
words, but not none, is one window. Window hashes that meet a training window are verified
word by word. The set is broadcast in blocks of at most ``block_windows`` windows; a larger
benchmark takes several blocks, each one more narrow pass over the texts and no shuffle.

Defined cases. Null or empty texts, and texts without a word, have no words and no hits. An
item whose text is null or wordless has no window. An item without id still hits, but cannot
be listed. Repeated items and repeated documents count as they stand: every document row has
its own result row. Empty tables give empty results or no hits. Input columns named like a
result column are replaced by it. Very long texts are scanned whole, their window hashes in
slices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgelake.llm.textblocks import plain_words, raw_texts, rolling_hashes, slices, words_of

WINDOW = 10
BLOCK_WINDOWS = 200_000  # windows in one broadcast; some 100 bytes each
HITS, ITEMS = "hit_words", "hit_items"
_WINDOW_ROWS = pa.schema([("width", pa.int32()), ("gram", pa.binary()), ("item", pa.string())])


def windows(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """One row per distinct window and item: its number of words, the words and the item's id."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            for item, text in zip(batch.column("item").to_pylist(), raw_texts(batch, "text")):
                words = plain_words(text or b"")
                width = min(window, len(words))
                if not width:
                    continue
                grams = {b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)}
                rows = [(width, g, item) for g in sorted(grams)]
                for a in range(0, len(rows), 10_000):
                    columns = zip(*rows[a : a + 10_000])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), f.type) for c, f in zip(columns, _WINDOW_ROWS)], schema=_WINDOW_ROWS
                    )

    narrow = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(cut, "width int, gram binary, item string").distinct()


class _Grams:
    """One block of windows, by number of words: sorted hashes, and for each hash the
    windows that have it with their items."""

    def __init__(self, rows: list[tuple[int, bytes, str | None]]) -> None:
        self.by_width: dict[int, tuple[np.ndarray, dict[int, dict[bytes, list[str]]]]] = {}
        table: dict[int, dict[int, dict[bytes, list[str]]]] = {}
        widths: dict[int, dict[bytes, list[str]]] = {}
        for width, gram, item in rows:
            items = widths.setdefault(width, {}).setdefault(bytes(gram), [])
            if item is not None:
                items.append(item)
        for width, grams in widths.items():
            names = list(grams)
            # A word repeats nowhere in a joined window but by value, so hash them all at once.
            words = words_of(names)
            hashes = rolling_hashes(words.hashes, width)[::width]
            for name, h in zip(names, hashes.tolist()):
                table.setdefault(width, {}).setdefault(h, {})[name] = grams[name]
            self.by_width[width] = np.unique(hashes), table[width]

    def scan(self, texts: list[bytes | None]) -> list[tuple[int, list[int], set[str]]]:
        """Per text: number of words, hit word ranges as flat ``[start, end, ...)``, items."""
        words = words_of(texts)
        first = words.first(len(texts))
        found: list[tuple[list[tuple[int, int]], set[str]]] = [([], set()) for _ in texts]
        for width, (known, table) in self.by_width.items():
            hashes = rolling_hashes(words.hashes, width)
            if not len(hashes):
                continue
            place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            maybe = (known[place] == hashes) & (words.rows[: len(hashes)] == words.rows[width - 1 :])
            for i in np.flatnonzero(maybe).tolist():
                row = int(words.rows[i])
                span = texts[row][words.starts[i] : words.ends[i + width - 1]]
                items = table[int(hashes[i])].get(b" ".join(plain_words(span)))
                if items is not None:
                    at = i - int(first[row])
                    found[row][0].append((at, at + width))
                    found[row][1].update(items)
        return [
            (int(first[r + 1] - first[r]), merged(ranges), items) for r, (ranges, items) in enumerate(found)
        ]


def merged(ranges: list[tuple[int, int]]) -> list[int]:
    """Union of half-open ranges, flat and in order."""
    out: list[int] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def scan(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_words`` (flat word ranges, end exclusive) and
    ``hit_items`` (sorted ids of the items with occurring windows)."""
    spark = docs.sparkSession
    grams = windows(items, window, item_id, item_text).persist()
    n_blocks = max(1, -(-grams.count() // block_windows))
    kept = [c for c in docs.columns if c not in ("n_words", HITS, ITEMS)]
    empty = F.array().cast("array<bigint>"), F.array().cast("array<string>")
    df = docs.select(*kept, F.lit(0).cast("bigint").alias("n_words"), empty[0].alias(HITS), empty[1].alias(ITEMS))
    spread = F.pmod(F.xxhash64("gram", F.coalesce("item", F.lit(""))), F.lit(n_blocks))
    for block in range(n_blocks):
        rows = [tuple(r) for r in grams.where(spread == block).collect()]
        df = _pass(df, spark.sparkContext.broadcast(rows), text_col)
    grams.unpersist()
    return df


def _pass(df: DataFrame, block, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = _Grams(block.value)
        for batch in slices(batches, text_col):
            results = grams.scan(raw_texts(batch, text_col))
            before = batch.column(HITS).to_pylist(), batch.column(ITEMS).to_pylist()
            hits, items = [], []
            for old_hits, old_items, (_, ranges, found) in zip(*before, results):
                pairs = [*zip(old_hits[::2], old_hits[1::2]), *zip(ranges[::2], ranges[1::2])]
                hits.append(merged(pairs))
                items.append(sorted({*old_items, *found}))
            new = {"n_words": [r[0] for r in results], HITS: hits, ITEMS: items}
            arrays = [
                pa.array(new[f.name], f.type) if f.name in new else batch.column(f.name) for f in batch.schema
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return df.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType) for f in df.schema]))


def n_hit_words(hits: str = HITS) -> F.Column:
    """Number of words in flat ranges."""
    sign = F.transform(F.col(hits), lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    return F.aggregate(sign, F.lit(0).cast("bigint"), lambda a, x: a + x)


def report(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per document: what was hit, with a digest of the listed items."""
    found = scan(docs.select("doc_id", "text"), items, window, block_windows)
    return found.select(
        "doc_id",
        "n_words",
        n_hit_words().alias("n_hit"),
        F.size(ITEMS).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ITEMS, ","), 256).alias("items_sha256"),
        (F.size(HITS) > 0).alias("contaminated"),
    )


def drop_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without a hit, in their own columns."""
    columns = docs.columns
    return scan(docs, items, window).where(F.size(HITS) == 0).select(*columns)


def remove_spans(docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text") -> DataFrame:
    """The documents with hit words cut out of the text, from the first letter of a hit
    range to its last."""
    columns = docs.columns
    found = scan(docs, items, window)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            texts = raw_texts(batch, text_col)
            words = words_of(texts)
            first = words.first(len(texts))
            for row, hits in enumerate(batch.column(HITS).to_pylist()):
                text, parts, done = texts[row], [], 0
                for a, b in zip(hits[::2], hits[1::2]):
                    parts.append(text[done : words.starts[first[row] + a]])
                    done = int(words.ends[first[row] + b - 1])
                if hits:
                    texts[row] = b"".join([*parts, text[done:]])
            at = batch.schema.get_field_index(text_col)
            clean = pa.array(texts, pa.binary()).cast(batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), clean)

    schema = T.StructType([T.StructField(f.name, f.dataType) for f in found.schema])
    return found.mapInArrow(cut, schema).select(*columns)
