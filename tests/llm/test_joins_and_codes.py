"""Fill-in-middle, grouped Jaccard join and dual-tree codes against plain versions."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forgelake.llm import dart_minhash, dual_tree, fim, group_join, tables, tiles
from forgelake.llm.tables import free_names

DOCS = "doc_id bigint, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- fill-in-middle


def plain_fim(doc_id, text):
    text = text or ""
    h = [int(sha(f"1:{'' if doc_id is None else doc_id}")[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    x, y, z = text[:a], text[a:b], text[b:]
    out = f"<S>{z}<P>{x}<M>{y}" if h[3] % 100 < 20 else f"<P>{x}<S>{z}<M>{y}"
    return n, "spm" if h[3] % 100 < 20 else "psm", a, b - a, out


def test_fill_in_middle_equals_plain_version(spark):
    rng = random.Random(5)
    letters = "ab é中😀\n<>PSM"
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randrange(60)))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (None, "no id"), (1002, "x<S>y"), (1003, "é" * 700_000), (1004, "same"), (1004, "same")]
    df = spark.createDataFrame(rows, DOCS)
    got = fim.fill_in_middle(df).withColumn("again", fim.restored(F.col("form"), F.col("output"))).collect()
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    found = sorted((repr(r.doc_id), r.n_units, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got)
    assert repr(found) == repr(sorted((repr(i), *plain_fim(i, t)) for i, t in rows))
    assert all(r.again == (r.text or "") for r in got)


@pytest.mark.parametrize("units", ["chars", "words", "lines"])
def test_units_put_together_are_the_text(units, monkeypatch):
    monkeypatch.setattr(fim, "_UNIT", 7)

    @settings(max_examples=80, deadline=None)
    @given(st.lists(st.text(alphabet="ab \n\té中😀", max_size=40), min_size=1, max_size=4), st.integers(0, 99), st.integers(0, 99))
    def check(texts, i, j):
        data = [t.encode() for t in texts]
        counts = fim.count_units(pa.array(texts, pa.string()), units)
        low, high = np.minimum(i, j) % (counts + 1), np.maximum(i, j) % (counts + 1)
        low, high = np.minimum(low, high), np.maximum(low, high)
        pieces = fim.pieces_of(data, low, high, units)
        assert [b"".join(p) for p in zip(*(x.to_pylist() for x in pieces))] == data
        if units == "chars":
            assert [len(t) for t in texts] == counts.tolist()
            assert pieces[0].to_pylist() == [t[:a].encode() for t, a in zip(texts, low)]

    check()


def test_fill_in_middle_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "text", "mine", "other")], DOCS + ", h1 string, output string")
    row = fim.fill_in_middle(df).first()
    assert row.h1 == "mine" and row.output != "other" and row.n_units == 4
    assert fim.fill_in_middle(df.limit(0)).count() == 0
    assert fim.digests(fim.fill_in_middle(df)).columns == [
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256",
    ]
    with pytest.raises(ValueError):
        fim.unit_starts(np.zeros(3, np.uint8), "pages")


def test_free_names():
    assert free_names(["a", "B_", "b"], "b", "a", "c") == ["b__", "a_", "c"]


# --- grouped prefix join


def shingle_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    k = min(4, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def plain_classes(rows):
    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    return {i: (max(len(s) for j, s in sets if j == i), find(i)) for i, _ in sets}


def near_copies(rng, groups, copies, words, change):
    rows = []
    vocabulary = [f"w{i}" for i in range(4000)]
    passage = [rng.choice(vocabulary) for _ in range(12)]
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(*words))]
        for _ in range(copies):
            text = [rng.choice(vocabulary) if rng.random() < change else w for w in base]
            if rng.random() < 0.5:
                text[3:3] = passage
            rows.append(" ".join(text))
    return list(enumerate(rows))


@pytest.mark.parametrize("short, tile", [(8, 256), (1, 5), (0, 3), (10_000, 256)])
def test_group_join_equals_all_pairs(spark, short, tile):
    rng = random.Random(7)
    rows = near_copies(rng, 6, 14, (30, 120), 0.012)
    rows += [(500 + i, t) for i, (_, t) in enumerate(rows[:10])]  # exact copies
    rows += [(600, None), (601, ""), (602, " \n\t"), (603, "One two"), (604, "one  TWO"), (605, "one two three"), (None, rows[0][1])]
    rows += [(0, rows[70][1]), (5, rows[5][1])]  # a second text under an id, and a repeated row
    df = spark.createDataFrame(rows, DOCS).withColumn("key", F.lit("mine")).withColumn("node", F.lit(1))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in group_join.classes(df, short=short, tile_nodes=tile).collect()}
    want = plain_classes(rows)
    assert got == want
    assert len({c for _, c in want.values()}) < len(want)


def test_group_join_of_nothing(spark):
    assert group_join.classes(spark.createDataFrame([], DOCS)).count() == 0
    rows = group_join.classes(spark.createDataFrame([(3, None), (4, "")], DOCS)).collect()
    assert sorted(map(tuple, rows)) == [(3, 0, 3), (4, 0, 4)]


def test_group_join_of_a_long_text(spark):
    rng = random.Random(3)
    words = [f"v{rng.randrange(10**6)}" for _ in range(60_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-2000])), (3, " ".join(words[:30_000]))]
    got = {r.doc_id: r.component_id for r in group_join.classes(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.frozensets(st.integers(-20, 20), max_size=12), min_size=1, max_size=8), st.lists(st.frozensets(st.integers(-20, 20), max_size=12), min_size=1, max_size=8))
def test_intersections(left, right):
    arrays = [[np.array(sorted(s), np.int64) for s in side] for side in (left, right)]
    assert tiles.intersections(*arrays).tolist() == [[len(a & b) for b in right] for a in left]


def test_tile_rows_are_linear_in_a_group(spark):
    """A group whose members are all alike gives as many rows as members, not pairs."""
    linked = np.ones((300, 300), bool)
    a, b = tiles.forest(linked, np.arange(300), np.arange(300))
    assert len(a) == 299 and set(a) == {0}


# --- dual trees


def plain_lloyd(rows, parts=4, entries=256, rounds=4):
    """``rows`` of (id, vector); codes and errors by plain loops over Python integers."""
    from math import floor, isfinite

    kept = [(i, v) for i, v in rows if v is not None and all(x is not None and isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    whole = [[floor(1024 * x) for x in v] for _, v in kept]
    dim = len(whole[0])
    cut = [(p * dim // parts, (p + 1) * dim // parts) for p in range(parts)]
    books = [[v[a:b] for v in whole[:entries]] for a, b in cut]

    def nearest(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, c)), k) for k, c in enumerate(book))

    for _ in range(rounds):
        for p, (a, b) in enumerate(cut):
            held = {}
            for v in whole:
                held.setdefault(nearest(v[a:b], books[p])[1], []).append(v[a:b])
            for k, members in held.items():
                books[p][k] = [sum(x) // len(members) for x in zip(*members)]
    found = []
    for (i, _), v in zip(kept, whole):
        best = [nearest(v[a:b], books[p]) for p, (a, b) in enumerate(cut)]
        found.append((i, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best)))
    return found, books


def coded(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int, code string")
    books = dual_tree.fit(df, **options)
    out = dual_tree.encode(df, books)
    return books, dual_tree.with_label_errors(out)


@pytest.mark.parametrize("scale", [1.0, 1e-3, 1e12, 1e40])
def test_codes_equal_plain_lloyd(spark, scale):
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(6, 10))
    vectors = (centres[rng.integers(0, 6, 120)] + rng.normal(size=(120, 10)) * 0.1) * scale
    rows = [(i, v.tolist(), int(i % 3) if i % 7 else None, "old") for i, v in enumerate(vectors)]
    rows += [(500, rows[3][1], 1, ""), (3, rows[3][1], 1, ""), (None, rows[4][1], None, "")]
    rows += [(501, None, 1, ""), (502, [None] * 10, 1, ""), (503, [float("nan")] * 10, 1, ""), (504, [float("inf")] * 10, 1, "")]
    rows += [(505, [1.0] * 3, 1, "")]
    books, out = coded(spark, rows, entries=16)
    want, want_books = plain_lloyd([r[:2] for r in rows if r[0] != 505], entries=16)
    got = out.collect()
    held = [(i, c, min(e, 2**63 - 1)) for i, c, e in want]
    assert sorted(((r.vec_id, r.code, r.error) for r in got), key=repr) == sorted(held, key=repr)
    assert [[[int(x) for x in c] for c in b] for b in books.books] == want_books
    flat = [str(x) for b in want_books for c in b for x in c]
    assert books.sha256() == sha(",".join(flat))
    sums = {}
    for r in got:
        sums[r.label] = sums.get(r.label, 0) + r.error
    assert all(r.label_error == min(sums[r.label], 2**63 - 1) for r in got)
    assert None in sums


def test_codes_of_few_and_no_vectors(spark):
    books, out = coded(spark, [(1, [0.5] * 8, 1, ""), (2, [0.5] * 8, 1, "")])
    assert [tuple(r)[3:5] for r in out.collect()] == [("00000000", 0)] * 2 or {r.code for r in out.collect()} == {"00000000"}
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<double>, label int, code string")
    books = dual_tree.fit(empty)
    assert dual_tree.with_label_errors(dual_tree.encode(empty, books)).count() == 0
    assert books.sha256() == sha("")
    with pytest.raises(ValueError):
        dual_tree.fit(empty, entries=300)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 400), st.integers(1, 40), st.integers(0, 5), st.integers(1, 6))
def test_dual_walk_finds_the_nearest(seed, n, k, width, spread):
    rng = np.random.default_rng(seed)
    rows = rng.integers(-spread, spread + 1, (n, width))
    book = rng.integers(-spread, spread + 1, (k, width))
    want = ((rows[:, None] - book[None]) ** 2).sum(axis=2)
    entry, distance = dual_tree.nearest(rows, book)
    assert entry.tolist() == want.argmin(axis=1).tolist() and distance.tolist() == want.min(axis=1).tolist()
    held = rows[dual_tree.tree_order(rows, dual_tree._LEAF)]
    sums, counts = np.zeros(book.shape, np.int64), np.zeros(k, np.int64)
    sums = dual_tree.add_sums(held, book, sums, counts)
    for c in range(k):
        assert counts[c] == (entry == c).sum() and (sums[c] == rows[entry == c].sum(axis=0)).all()


def test_whole_nodes_are_assigned_by_their_sums():
    """Well separated clusters are settled far above the leaves."""
    rng = np.random.default_rng(0)
    centres = rng.integers(-10_000, 10_000, (8, 4))
    rows = centres[rng.integers(0, 8, 4096)] + rng.integers(-3, 4, (4096, 4))
    rows = rows[dual_tree.tree_order(rows, dual_tree._LEAF)]
    told = {"whole": 0, "leaf": 0}
    tree = dual_tree.Tree(rows, dual_tree._LEAF, False)
    entries, index = dual_tree._entry_tree(centres)

    def whole(level, nodes, entry):
        edges = tree.edges(level)
        told["whole"] += int((edges[nodes + 1] - edges[nodes]).sum())

    def leaf(node, candidates):
        told["leaf"] += int(np.diff(tree.edges(tree.depth))[node])

    dual_tree.dual_walk(tree, entries, index, whole, leaf)
    assert told["whole"] > 10 * told["leaf"] and sum(told.values()) == 4096


def test_crowds_are_joined_once(spark, monkeypatch):
    from forgelake.llm import dart_minhash

    plans, fill = [], dart_minhash.fill_tiles

    def noted(dealt, nodes):
        plans.append(dealt._jdf.queryExecution().optimizedPlan().toString())
        return fill(dealt, nodes)

    monkeypatch.setattr(dart_minhash, "fill_tiles", noted)
    base = " ".join(f"w{i}" for i in range(120))
    docs = spark.createDataFrame([(i, f"{base} x{i}") for i in range(8)], "doc_id bigint, text string")
    found = {r.doc_id: r.class_id for r in dart_minhash.classes(docs).collect()}
    assert found == dict.fromkeys(range(8), 0)
    assert plans and "Join" not in plans[0]


def test_only_texts_that_are_compared_are_shuffled(spark, monkeypatch):
    """The texts are sifted by a bitmap before the exact join, whatever Spark may broadcast by itself."""
    ids = list(range(-50, 5000, 7)) + [2**62, -(2**62)]
    wanted = spark.createDataFrame([(i,) for i in ids], "doc_id bigint")
    rows = spark.range(-20_000, 20_000).selectExpr("id AS doc_id", "CAST(id AS string) AS chunk", "id AS bits")
    rows = rows.union(spark.createDataFrame([(2**62, "x", 1), (-(2**62), "y", 1), (None, "z", 1)], "doc_id bigint, chunk string, bits bigint"))
    found = [r.doc_id for r in tables.sifted(rows, wanted, "doc_id").collect()]
    assert set(ids) <= set(found) and len(set(found)) == len(found) < len(ids) + 40_000 // 8
    assert tables.sifted(rows, wanted.limit(0), "doc_id").count() == 0

    plans, read = [], []

    def kept(df, label):
        if label == "candidate-texts":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
            read.append([r.doc_id for r in df.collect()])
        return tables.stored(df, label)

    monkeypatch.setattr(dart_minhash, "stored", kept)
    texts = [" ".join(f"w{i}x{k}" for k in range(60)) for i in range(300)]
    texts += [texts[5] + " end", texts[9] + " end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    classes = {r.doc_id: r.class_id for r in dart_minhash.classes(docs).collect()}
    assert {d: c for d, c in classes.items() if d != c} == {300: 5, 301: 9}
    assert sorted(read[0]) == [5, 9, 300, 301] and "bitmap_construct_agg" in plans[0]
