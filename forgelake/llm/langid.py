"""Language identification by nearest centroid.

A text is the vector of its byte n-grams (2 to 4 bytes within words, spaces at the edges),
hashed to ``DIMS`` places, weighted by TF-IDF and normalised. Each language has several
centroids, found by spherical k-means among its training texts. A text takes the language of
the nearest centroid by cosine; if it is much farther from it than any training text, or
beginning of one, of comparable length is from centroids learned without it, it is rejected.

The classifier is fitted on a sample of about ``PER_LANGUAGE`` labelled texts of a language,
those whose id's hash lies under the language's share; every other step covers all rows.

Defined cases. A null text, or one without a letter, is ``und`` with score 0 and rejected;
so is every text when nothing could be learned. A null id counts as not held out and is not
learned from. Repeated rows each get a result. Extra columns are ignored. Very long texts are
counted whole, in slices. Ties in cosine go to the first centroid in order of language. An empty table
teaches nothing and gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.llm.tables import free_names, stored
from forgelake.llm.textblocks import U64, mix, raw_texts, slices

DIMS = 1 << 13
ORDERS = (2, 3, 4)
CENTROIDS = 4
PER_LANGUAGE = 400  # bound of the training sample, per language
STEPS = 8  # of k-means
LENGTHS = (32, 128, 512)  # bytes that part texts into classes of comparable length
SLACK = 0.5  # reject below this share of the class's lowest training cosine
FOLDS = 5  # documents whose crc32(id) is divisible by it are held out
UNKNOWN = "und"
_PLACES = 1 << 40
_BLOCK = 1 << 18
# Bytes that count in n-grams: A-Z lower-cased, other letters and non-ASCII kept, else space.
_LETTERS = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256)], np.uint8)


def has_letter(text: bytes | None) -> bool:
    """Whether any character is a letter of any script."""
    if not text:
        return False
    if text.isascii():
        return any(65 <= b <= 90 or 97 <= b <= 122 for b in text)
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def counts(texts: list[bytes]) -> np.ndarray:
    """Hashed n-gram counts, one row per text. Texts are counted piece by piece; the pieces
    of a long text overlap by what the longest n-gram needs."""
    out = np.zeros((len(texts), DIMS), np.float32)
    buffer: list[tuple[int, bytes]] = []

    def flush() -> None:
        if not buffer:
            return
        data = _LETTERS[np.frombuffer(b" ".join(p for _, p in buffer) + b" ", np.uint8)]
        row = np.repeat([r for r, _ in buffer], [len(p) + 1 for _, p in buffer])
        # Runs of spaces shrink to one, so that word edges look alike.
        keep = np.ones(len(data), bool)
        keep[1:] = (data[1:] != 32) | (data[:-1] != 32)
        data, row = np.concatenate([[np.uint8(32)], data[keep]]), np.concatenate([row[:1], row[keep]])
        wide = data.astype(np.uint32)
        edge = data == 32
        for n in ORDERS:
            size = len(data) - n + 1
            if size <= 0:
                continue
            gram = np.full(size, n, np.uint32)
            plain = np.ones(size, bool)
            for i in range(n):
                gram = gram * np.uint32(0x01000193) ^ wide[i : i + size]
                if 0 < i < n - 1:
                    plain &= ~edge[i : i + size]
            gram ^= gram >> np.uint32(15)
            gram *= np.uint32(0x2C1B3C6D)
            gram ^= gram >> np.uint32(13)
            # A gram belongs to the text of its second byte: the first may be the space before.
            place = row[1 : 1 + size].astype(np.int64) * DIMS + (gram % np.uint32(DIMS))
            base = int(buffer[0][0])
            found = np.bincount(place[plain] - base * DIMS, minlength=(int(buffer[-1][0]) - base + 1) * DIMS)
            out[base : int(buffer[-1][0]) + 1] += found.reshape(-1, DIMS)
        buffer.clear()

    held = 0
    for i, text in enumerate(texts):
        for a in range(0, max(len(text), 1), _BLOCK):
            buffer.append((i, text[max(0, a - max(ORDERS) + 1) : a + _BLOCK] if a else text[:_BLOCK]))
            held += len(buffer[-1][1])
            if held >= _BLOCK:
                flush()
                held = 0
    flush()
    return out


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # one unit row each
    of: np.ndarray  # language of each centroid
    floors: np.ndarray  # lowest accepted cosine by length class

    def vectors(self, texts: list[bytes]) -> np.ndarray:
        tf = counts(texts)
        np.log1p(tf, out=tf)
        return unit(tf * self.idf)

    def predict(self, texts: list[bytes | None]) -> list[tuple[str, float, bool]]:
        """(language, cosine, rejected) of each text."""
        out = [(UNKNOWN, 0.0, True)] * len(texts)
        known = [i for i, t in enumerate(texts) if has_letter(t)] if self.languages else []
        for a in range(0, len(known), 128):
            part = known[a : a + 128]
            cosine = self.vectors([texts[i] for i in part]) @ self.centroids.T
            best = cosine.argmax(axis=1)
            for i, c, b in zip(part, cosine, best):
                score = float(min(1.0, max(0.0, c[b])))
                out[i] = self.languages[self.of[b]], score, score < self.floors[np.searchsorted(LENGTHS, len(texts[i]))]
        return out


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def remainder(id_col: str = "doc_id") -> F.Column:
    return F.crc32(F.col(id_col).cast("string")) % FOLDS


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Learn from ``doc_id, text, lang`` of documents that are not held out. The sample and
    its vectors stay in the tasks: one partial sum of document frequencies per task and the
    centroids of a language come back, whose sizes the parameters bound."""
    usable = labelled.where((remainder() != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], np.ones(DIMS, np.float32), np.zeros((0, DIMS), np.float32), np.zeros(0, int), np.zeros(0))
    # A uniform hash of the id below a share per language admits about the sample's size.
    place = F.pmod(F.xxhash64("doc_id"), F.lit(_PLACES))
    chosen = F.lit(False)
    for lang, size in sorted(sizes.items()):
        chosen = chosen | ((F.col("lang") == lang) & (place < int(_PLACES * min(1.0, per_language / size))))
    sample = usable.where(chosen).select("doc_id", "lang", "text").dropDuplicates(["doc_id", "lang"])
    sample = stored(sample, "langid-sample")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIMS), 0
        for batch in slices(batches, "text"):
            texts = [t for t in raw_texts(batch, "text") if has_letter(t)]
            for a in range(0, len(texts), 128):
                total += (counts(texts[a : a + 128]) > 0).sum(axis=0)
            n += len(texts)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.tolist()])], names=["n", "df"])

    parts = sample.select("text").mapInArrow(frequencies, "n bigint, df array<double>").collect()
    n, df = sum(p["n"] for p in parts), np.sum([p["df"] for p in parts], axis=0)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    held = sample.sparkSession.sparkContext.broadcast(idf)

    def cluster(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("doc_id").to_numpy(), kind="stable")
        raw = table.column("text").cast(pa.binary()).to_pylist()
        texts = [raw[i] for i in order if has_letter(raw[i])]
        rows = []
        if texts:
            empty = Model([], held.value, np.zeros((0, DIMS), np.float32), np.zeros(0, int), np.zeros(0))
            x = np.concatenate([empty.vectors(texts[a : a + 128]) for a in range(0, len(texts), 128)])
            centroids = kmeans(x)
            lowest = lowest_cosines(texts, x, empty)
            rows = [{"lang": key[0].as_py(), "centroid": c.tolist(), "lowest": lowest} for c in centroids]
        kinds = [("lang", pa.string()), ("centroid", pa.list_(pa.float32())), ("lowest", pa.list_(pa.float64()))]
        schema = pa.schema(kinds)
        return pa.Table.from_pylist(rows, schema=schema)

    found = sample.groupBy("lang").applyInArrow(cluster, "lang string, centroid array<float>, lowest array<double>").collect()
    found.sort(key=lambda r: (r["lang"], r["centroid"]))
    languages = sorted({r["lang"] for r in found})
    # A class that no training text reached rejects nothing.
    floors = [min([v for r in found if (v := r["lowest"][c]) is not None], default=0.0) for c in range(len(LENGTHS) + 1)]
    return Model(
        languages,
        idf,
        np.array([r["centroid"] for r in found], np.float32).reshape(-1, DIMS),
        np.array([languages.index(r["lang"]) for r in found], int),
        np.array(floors) * SLACK,
    )


def lowest_cosines(texts: list[bytes], x: np.ndarray, model: Model) -> list[float | None]:
    """The lowest cosine by length class of texts, and of their beginnings, with centroids
    learned without them; every class that a text reaches is measured on all of these."""
    lowest: list[float | None] = [None] * (len(LENGTHS) + 1)
    part = np.arange(len(texts)) % FOLDS
    for fold in range(FOLDS if len(texts) > 1 else 0):
        mine = np.flatnonzero(part == fold)
        if not len(mine):
            continue
        centroids = kmeans(x[part != fold])
        probes = [p for i in mine for p in beginnings(texts[i])]
        for a in range(0, len(probes), 128):
            some = probes[a : a + 128]
            nearest = (model.vectors(some) @ centroids.T).max(axis=1)
            for text, cosine in zip(some, nearest):
                c = int(np.searchsorted(LENGTHS, len(text)))
                lowest[c] = min(float(cosine), 1.0 if lowest[c] is None else lowest[c])
    return lowest


def beginnings(text: bytes) -> list[bytes]:
    """The text and its first words of each shorter length class, if they have letters."""
    out = {text}
    for limit in LENGTHS:
        cut = text.rfind(b" ", 0, limit + 1) if len(text) > limit else 0
        if cut > 0:
            out.add(text[:cut])
    return sorted(t for t in out if has_letter(t))


def kmeans(x: np.ndarray, k: int = CENTROIDS, steps: int = STEPS) -> np.ndarray:
    """Spherical k-means; the first centres are far apart, the first of all is the mean's
    nearest row. Few rows give fewer centroids."""
    centres = [x[int((x @ unit(x.mean(axis=0, keepdims=True)).T).argmax())]]
    while len(centres) < min(k, len(x)):
        nearest = (x @ np.array(centres).T).max(axis=1)
        if nearest.min() > 1 - 1e-6:
            break
        centres.append(x[int(nearest.argmin())])
    c = np.array(centres)
    for _ in range(steps):
        of = (x @ c.T).argmax(axis=1)
        c = unit(np.array([x[of == j].sum(axis=0) if (of == j).any() else c[j] for j in range(len(c))]))
    return c


def identify(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """Columns ``keep`` of ``docs`` with ``lang_pred``, ``score`` and ``rejected``; only the
    text is read for the prediction."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    results = ("lang_pred", "score", "rejected")
    names = [c for c in keep if c not in results]
    text = "text" if "text" in names else free_names(docs.columns, "input")[0]
    df = docs.select(*names) if text == "text" else docs.select(*names, F.col("text").alias(text))
    result = [("lang_pred", pa.string(), "string"), ("score", pa.float64(), "double"), ("rejected", pa.bool_(), "boolean")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            found = held.value.predict(raw_texts(batch, text))
            new = [pa.array([f[i] for f in found], kind) for i, (_, kind, _) in enumerate(result)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *new], names=[*names, *(r[0] for r in result)])

    schema = df.select(*names).schema
    for name, _, kind in result:
        schema = schema.add(name, kind)
    return df.mapInArrow(run, schema)
