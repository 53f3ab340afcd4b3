"""Words of whole texts as flat numpy arrays, computed inside Spark tasks.

A word is a maximal run of digits, ASCII letters and non-ASCII characters; A-Z are
lower-cased and nothing else is folded. In UTF-8 every byte of a non-ASCII character is
above 0x7F, so words can be found on bytes without decoding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SPACE = 0x20
# Byte to folded byte: word bytes keep their value, A-Z become a-z, the rest is a space.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else SPACE
    for b in range(256)
)
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLOCK = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit integers (splitmix64)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class _Powers:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            with np.errstate(over="ignore"):
                steps = np.full(n, _BASE, U64), np.full(n, _INVERSE, U64)
                for s in steps:
                    s[0] = 1
                self.up, self.down = (np.multiply.accumulate(s) for s in steps)
        return self.up, self.down


_POWERS = _Powers()


def window_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each slice ``values[start:end]``, equal for equal slices wherever they stand."""
    up, down = _POWERS.upto(len(values) + 1)
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def rolling_hashes(values: np.ndarray, width: int, step: int = 1 << 17) -> np.ndarray:
    """Hashes of all ``width`` consecutive values, worked through in bounded slices."""
    n = len(values) - width + 1
    out = np.zeros(max(n, 0), U64)
    for a in range(0, max(n, 0), step):
        b = min(a + step, n)
        at = np.arange(b - a)
        out[a:b] = window_hashes(values[a : b + width - 1], at, at + width)
    return out


@dataclass
class Words:
    """Words of several texts: hash, row of the text, byte span in the row's text."""

    hashes: np.ndarray
    rows: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def first(self, n_rows: int) -> np.ndarray:
        """Offsets of each row's words: row ``i`` owns ``[out[i], out[i + 1])``."""
        return np.searchsorted(self.rows, np.arange(n_rows + 1))


def _pieces(text: bytes, fold: bytes = FOLD) -> Iterator[tuple[int, bytes]]:
    """A long text cut before bytes that are in no word, else whole."""
    a = 0
    while len(text) - a > _BLOCK:
        b = a + _BLOCK
        while b < len(text) and fold[text[b]] != SPACE:
            b += 1
        yield a, text[a:b]
        a = b
    yield a, text[a:]


def words_of(texts: list[bytes | None], fold: bytes = FOLD) -> Words:
    """The words of all texts; a null or empty text has none. ``fold`` maps bytes to folded
    ones and to spaces."""
    found: list[tuple[np.ndarray, ...]] = []
    buffer: list[tuple[int, int, bytes]] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if not buffer:
            return
        data = np.frombuffer(b" ".join(p for _, _, p in buffer).translate(fold) + b" ", np.uint8)
        inside = data != SPACE
        edges = np.flatnonzero(np.diff(inside, prepend=False))
        starts, ends = edges[::2], edges[1::2]
        sizes = np.array([len(p) + 1 for _, _, p in buffer])
        begins = np.cumsum(sizes) - sizes
        piece = np.searchsorted(begins, starts, side="right") - 1
        shift = np.array([o for _, o, _ in buffer])[piece] - begins[piece]
        rows = np.array([r for r, _, _ in buffer], np.int64)[piece]
        found.append((window_hashes(data.astype(U64) + U64(1), starts, ends), rows, starts + shift, ends + shift))
        buffer.clear()
        held = 0

    for row, text in enumerate(texts):
        if not text:
            continue
        for offset, piece in _pieces(text, fold):
            buffer.append((row, offset, piece))
            held += len(piece)
            if held >= _BLOCK:
                flush()
    flush()
    if not found:
        return Words(np.zeros(0, U64), *(np.zeros(0, np.int64) for _ in range(3)))
    return Words(*(np.concatenate(x) for x in zip(*found)))


def plain_words(text: bytes) -> list[bytes]:
    """The words themselves; ASCII white space is all that the folding leaves between them."""
    return text.translate(FOLD).split()


def shingles_of(words: Words, n_rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and rows of all ``width`` consecutive words; a text of fewer words, but not
    none, has one shingle of all its words."""
    first = words.first(n_rows)
    hashes = rolling_hashes(words.hashes, width)
    rows = words.rows[: len(hashes)]
    whole = rows == words.rows[width - 1 :] if len(hashes) else np.zeros(0, bool)
    hashes, rows = hashes[whole], rows[whole]
    sizes = np.diff(first)
    short = np.flatnonzero((sizes > 0) & (sizes < width))
    if len(short):
        extra = np.concatenate([rolling_hashes(words.hashes[first[r] : first[r + 1]], int(sizes[r])) for r in short])
        hashes, rows = np.concatenate([hashes, extra]), np.concatenate([rows, short])
    return hashes, rows


def slices(batches, column: str, limit: int = 4 << 20, rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that ``column`` holds about ``limit`` bytes in each, and ``rows`` rows
    at most; a longer text stands alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        a, held = 0, 0
        for i, size in enumerate(sizes):
            if i > a and (held + size > limit or i - a >= rows):
                yield batch.slice(a, i - a)
                a, held = i, 0
            held += int(size)
        if len(sizes) > a:
            yield batch.slice(a)


def raw_texts(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """The UTF-8 bytes of a text column."""
    values = batch.column(column)
    binary = pa.large_binary() if pa.types.is_large_string(values.type) else pa.binary()
    return values.cast(binary).to_pylist()
