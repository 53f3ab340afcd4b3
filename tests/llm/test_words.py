"""Words, shingles and batch slicing against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from forgelake.llm.textblocks import plain_words, shingles_of, slices, words_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def expected(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="aZé0 .\n_-", max_size=40), max_size=6))
def test_words_match_the_pattern(texts):
    raw = [None if t is None else t.encode() for t in texts]
    words = words_of(raw)
    for row, text in enumerate(texts):
        spans = [(a, b) for a, b, r in zip(words.starts, words.ends, words.rows) if r == row]
        found = [plain_words(raw[row][a:b])[0].decode() for a, b in spans]
        assert found == expected(text) == [w.decode() for w in plain_words(raw[row] or b"")]


def test_hashes_depend_on_the_word_alone():
    words = words_of([b"one two", b"x" * 9 + b" TWO one"])
    by_word = dict(zip(["one", "two", "long", "two2", "one2"], words.hashes.tolist()))
    assert by_word["one"] == by_word["one2"] and by_word["two"] == by_word["two2"] != by_word["long"]


def test_long_text_is_worked_on_in_pieces():
    text = b"ab cd " * 200_000 + b"y" * 300_000
    words = words_of([text])
    assert len(words.hashes) == 400_001 and len(np.unique(words.hashes)) == 3
    assert words.ends[-1] == len(text)


def test_shingles_of_short_and_wordless_texts():
    hashes, rows = shingles_of(words_of([b"a b c d e f", b"a b", b"...", None]), 4, 5)
    assert sorted(rows.tolist()) == [0, 0, 1] and len(set(hashes.tolist())) == 3


def test_slices_keep_every_row():
    texts = [None, "a" * 50, "", "b" * 500, "c"] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    parts = list(slices([batch], "text", 100))
    assert [t for p in parts for t in p.column(0).to_pylist()] == texts and len(parts) > 3
