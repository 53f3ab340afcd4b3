"""Fill-in-middle transformation as an Arrow pipeline.

A text is cut into units and two places among them; what lies before, between and after is
written in an order from which a model learns to fill the middle, each part behind its mark.
``psm`` is prefix, suffix, middle and ``spm`` suffix, prefix, middle. Form and places come
from a keyed hash of the row's id, so that a run on other partitions gives the same rows.

Per batch: texts become list arrays of their units, the lists are flattened with the index of
their parent, each unit's ordinal gives its role, the units of a role are filtered and their
lists rebuilt, each list is joined to its piece, and marks and pieces are joined in order. A
long text is worked through in slices of ``_UNIT`` bytes, so that lists of units never
hold more than that however long it is; only the text and its pieces are held whole.

Units: ``chars`` are code points, ``words`` run from a word's first byte to the next one's
(white space before the first word belongs to it), ``lines`` end behind their line break.
Units of each kind put together are the text.

Defined cases. A null text is taken as empty, and an empty text is ``plain``: written as it
is. So is a text that contains a mark, as it could not be told apart again. A null id hashes
like an empty one; repeated rows get equal results. Very long texts are transformed whole.
Extra columns pass through, but those named like a result column are replaced; no other name
clashes. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgelake.llm.tables import free_names
from forgelake.llm.textblocks import slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
RESULT = ("n_units", "form", "prefix_chars", "middle_chars", "output")
_UNIT = 1 << 20  # bytes of text whose units are listed together
_BATCH = 4 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def draws(id_col: str, seed: str = "1") -> list[Column]:
    """Four numbers below 2**32 from the hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]


def unit_starts(data: np.ndarray, units: str) -> np.ndarray:
    """Where in the UTF-8 bytes units begin; the first is at 0."""
    if units == "chars":
        new = (data & 0xC0) != 0x80
    elif units == "lines":
        new = np.zeros(len(data), bool)
        new[1:] = data[:-1] == 0x0A
    elif units == "words":
        space = _SPACE[data]
        new = ~space
        new[1:] &= space[:-1]
        # White space at the very beginning goes with the first word.
        first = np.flatnonzero(new)
        new[first[:1]] = False
    else:
        raise ValueError(f"unknown units {units!r}")
    if len(new):
        new[0] = True
    return np.flatnonzero(new)


def _parts(data: bytes, units: str) -> Iterator[tuple[bytes, np.ndarray]]:
    """Slices of a text that begin with a unit, and the places of units in each; a unit
    longer than a slice makes its slice longer."""
    a, size = 0, _UNIT
    while a < len(data):
        part = np.frombuffer(data, np.uint8, min(size, len(data) - a), a)
        starts = unit_starts(part, units)
        if a + len(part) < len(data):
            if len(starts) < 2:
                size *= 2
                continue
            # The last unit may go on behind the slice.
            part, starts = part[: starts[-1]], starts[:-1]
        yield part.tobytes(), starts
        a, size = a + len(part), _UNIT


def count_units(texts: pa.Array, units: str) -> np.ndarray:
    """Units of each text; null has none."""
    counts = np.zeros(len(texts), np.int64)
    for row, text in enumerate(texts.cast(pa.large_binary())):
        data = text.as_py() or b""
        counts[row] = sum(len(starts) for _, starts in _parts(data, units))
    return counts


def _unit_lists(texts: list[bytes], units: str) -> Iterator[tuple[np.ndarray, np.ndarray, pa.LargeListArray]]:
    """Groups of slices of about ``_UNIT`` bytes: the row of each slice, the ordinal of its first
    unit in the row, and its units as a list."""
    rows, bases, parts, places, held = [], [], [], [], 0

    def group():
        sizes = np.array([len(s) for s in places])
        shifts = np.cumsum([0, *(len(p) for p in parts)])
        starts = np.concatenate([s + d for s, d in zip(places, shifts)] + [shifts[-1:]])
        buffers = [None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(b"".join(parts))]
        values = pa.BinaryArray.from_buffers(pa.binary(), len(starts) - 1, buffers)
        lists = pa.LargeListArray.from_arrays(pa.array(np.cumsum([0, *sizes])), values)
        return np.array(rows), np.array(bases), lists

    for row, text in enumerate(texts):
        base = 0
        for part, starts in _parts(text, units):
            rows.append(row)
            bases.append(base)
            parts.append(part)
            places.append(starts)
            base, held = base + len(starts), held + len(part)
            if held >= _UNIT:
                yield group()
                rows, bases, parts, places, held = [], [], [], [], 0
    if rows:
        yield group()


def pieces_of(texts: list[bytes], low: np.ndarray, high: np.ndarray, units: str) -> list[pa.Array]:
    """Prefix, middle and suffix of each text, cut before its units ``low`` and ``high``."""
    found: list[list[pa.Array]] = [[], [], []]
    owners = []
    for rows, bases, lists in _unit_lists(texts, units):
        flat, parent = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
        offsets = lists.offsets.to_numpy()
        ordinal = np.arange(len(flat)) - offsets[parent] + bases[parent]
        role = (ordinal >= low[rows][parent]).astype(np.int8) + (ordinal >= high[rows][parent])
        owners.append(rows)
        for r in range(3):
            mine = role == r
            sizes = np.bincount(parent[mine], minlength=len(lists))
            kept = flat.filter(pa.array(mine))
            rebuilt = pa.LargeListArray.from_arrays(pa.array(np.cumsum([0, *sizes])), kept)
            found[r].append(pc.binary_join(rebuilt, b""))
    if not owners:
        return [pa.array([b""] * len(texts), pa.binary())] * 3
    # The slices of one text follow each other: lists of slices, joined once more.
    counts = np.bincount(np.concatenate(owners), minlength=len(texts))
    bounds = pa.array(np.cumsum([0, *counts]))
    return [pc.binary_join(pa.LargeListArray.from_arrays(bounds, pa.concat_arrays(x)), b"") for x in found]


def joined(texts: list[bytes], forms: pa.Array, low: np.ndarray, high: np.ndarray, units: str) -> tuple[pa.Array, list[pa.Array]]:
    """The outputs, and the three pieces of each text."""
    prefix, middle, suffix = pieces_of(texts, low, high, units)
    p, s, m = (pa.scalar(x.encode(), pa.binary()) for x in (PREFIX, SUFFIX, MIDDLE))
    none = pa.scalar(b"", pa.binary())
    psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, none)
    spm = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, none)
    plain = pa.array(texts, pa.binary())
    out = pc.if_else(pc.equal(forms, PLAIN), plain, pc.if_else(pc.equal(forms, PSM), psm, spm))
    return out, [prefix, middle, suffix]


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    units: str = "chars",
    seed: str = "1",
    plain_percent: int = 10,
    spm_percent: int = 20,
) -> DataFrame:
    """``docs`` with ``n_units, form, prefix_chars, middle_chars, output``.

    The places are the smaller and the larger of two draws among the ``n_units + 1`` borders;
    ``plain_percent`` of all rows stay plain and ``spm_percent`` of the others are written
    suffix first. Lengths of pieces are in code points, and null for plain rows.
    """
    kept = [c for c in docs.columns if c not in RESULT or c == text_col]
    h = free_names(docs.columns, "h1", "h2", "h3", "h4")
    drawn = docs.select(*kept, *(d.alias(n) for d, n in zip(draws(id_col, seed), h)))
    clash = [c for c in kept if c in RESULT]  # the text column itself may be called "output"
    fields = [T.StructField(f.name, f.dataType) for f in drawn.select(*[c for c in kept if c not in clash]).schema]
    passed = [f.name for f in fields]
    kinds = dict(zip(RESULT, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())))
    spark_kinds = {"n_units": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "output": "string"}
    schema = T.StructType(fields)
    for name in RESULT:
        schema = schema.add(name, spark_kinds[name])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, _BATCH):
            column = batch.column(text_col)
            texts = [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]
            first, second, third, fourth = (batch.column(n).to_numpy() for n in h)
            n = count_units(column, units)
            a, b = first % (n + 1), second % (n + 1)
            marked = [any(x.encode() in t for x in (PREFIX, SUFFIX, MIDDLE)) for t in texts]
            plain = (n == 0) | np.array(marked, bool) | (third % 100 >= 100 - plain_percent)
            form = np.where(plain, PLAIN, np.where(fourth % 100 < spm_percent, SPM, PSM))
            forms = pa.array(form.tolist(), pa.string())
            out, (prefix, middle, _) = joined(texts, forms, np.minimum(a, b), np.maximum(a, b), units)
            shown = pa.array(~plain)
            sizes = [pc.if_else(shown, pc.utf8_length(x.cast(pa.string())).cast(pa.int64()), None) for x in (prefix, middle)]
            results = dict(zip(RESULT, (pa.array(n), forms, *sizes, out.cast(pa.string()))))
            arrays = [batch.column(c) for c in passed] + [results[c].cast(kinds[c]) for c in RESULT]
            yield pa.RecordBatch.from_arrays(arrays, names=[*passed, *RESULT])

    return drawn.mapInArrow(run, schema)


def restored(form: Column, output: Column) -> Column:
    """The text again, from what was written and its form. The marks are not in the text and
    cannot arise where pieces meet, so the first of each kind is the one written."""
    body = F.substring(output, len(PREFIX) + 1, 2**31 - 1)
    head = F.substring_index(body, MIDDLE, 1)
    middle = F.substr(body, F.length(head) + F.lit(len(MIDDLE) + 1))

    def parts(mark: str) -> tuple[Column, Column]:
        one = F.substring_index(head, mark, 1)
        return one, F.substr(head, F.length(one) + F.lit(len(mark) + 1))

    (prefix, suffix), (last, first) = parts(SUFFIX), parts(PREFIX)
    return (
        F.when(form == PLAIN, output)
        .when(form == PSM, F.concat(prefix, middle, suffix))
        .otherwise(F.concat(first, middle, last))
    )


def digests(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Row digests of ``fill_in_middle``."""
    return df.select(
        id_col,
        F.col("n_units").alias("n"),
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"),
    )
