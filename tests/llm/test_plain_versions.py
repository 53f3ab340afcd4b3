"""Operators against plain versions of their rules."""

import hashlib
import math
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from forgelake.llm import chaining, langid, pii
from forgelake.llm.tables import stored
from forgelake.llm.textblocks import rolling_hashes, words_of

# --- pseudonyms


def plain_feistel(value, a, b, key, tweak, rounds=pii.ROUNDS):
    left, right = divmod(value, b)
    for i in range(rounds):
        size, other = (a, right) if i % 2 == 0 else (b, left)
        draw = int(hashlib.sha256(f"{key}|{tweak}|{i}|{other}".encode()).hexdigest()[:15], 16) % size
        if i % 2 == 0:
            left = (left + draw) % a
        else:
            right = (right + draw) % b
    return left * b + right


def plain_digits(digits, key, tweak):
    n = len(digits)
    half = n // 2
    out = plain_feistel(int(digits), 10 ** (n - half), 10**half, key, f"{tweak}|{n}")
    return str(out).zfill(n)


def luhn(body):
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c)
        total += d if i % 2 else (2 * d - 9 if d > 4 else 2 * d)
    return str(-total % 10)


def test_permutations_equal_plain_networks(spark):
    digits = ["0", "7", "42", "000", "123456789", "411111111111111", "999999999999999999"]
    df = spark.createDataFrame([(d,) for d in digits], "d string")
    rows = df.select("d", pii.permuted_digits(F.col("d"), "k", F.lit("t")).alias("out")).collect()
    assert {r.d: r.out for r in rows} == {d: plain_digits(d, "k", "t") for d in digits}
    whole = spark.range(189 * 7).select("id", pii.feistel(F.col("id"), F.lit(189), F.lit(7), "k", F.lit("d")).alias("out"))
    got = {r.id: r.out for r in whole.collect()}
    assert got == {i: plain_feistel(i, 189, 7, "k", "d") for i in got} and len(set(got.values())) == len(got)


def test_check_digits_equal_plain_ones(spark):
    bodies = ["411111111111111", "37828224631000", "0", "79927398713"]
    df = spark.createDataFrame([(b,) for b in bodies], "b string")
    rows = df.select("b", pii.check_digit(F.col("b")).alias("c")).collect()
    assert {r.b: r.c for r in rows} == {b: luhn(b) for b in bodies}


def test_cards_in_texts_equal_the_plain_rule(spark):
    key = pii.KEY
    text = "pay 4111 1111 1111 1111 or 4111111111111112 now"
    (row,) = pii.pseudonymise(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).collect()
    found = row.text.split(" ")
    card = "".join(found[1:5])
    assert luhn(card[:-1]) == card[-1] and card != "4111111111111111"
    assert found[6] == "4111111111111112"  # fails its check digit
    assert len(card) == 16 and key


# --- language identification


def plain_counts(text):
    """Occurrences of byte n-grams in their slots, one by one. Grams lie within a word and the
    spaces around it."""
    letters = bytes(langid._LETTERS.tolist())
    data = b" " + re.sub(b" +", b" ", (text + b" ").translate(letters))
    out = {}
    for n in langid.ORDERS:
        for i in range(len(data) - n + 1):
            gram = data[i : i + n]
            if b" " in gram[1 : n - 1]:
                continue
            h = n
            for byte in gram:
                h = (h * 0x01000193 & 0xFFFFFFFF) ^ byte
            h ^= h >> 15
            h = h * 0x2C1B3C6D & 0xFFFFFFFF
            h ^= h >> 13
            out[h % langid.DIMS] = out.get(h % langid.DIMS, 0) + 1
    return out


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return docs, langid.fit(docs)


def test_predictions_equal_plain_cosines(fitted):
    docs, model = fitted
    rows = langid.identify(docs, model, "doc_id", "text").collect()
    assert len(rows) == docs.count()
    for r in rows[::4]:
        tf = plain_counts(r.text.encode())
        weights = {i: math.log1p(x) * float(model.idf[i]) for i, x in tf.items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        cosines = [sum(w * float(c[i]) for i, w in weights.items()) / norm for c in model.centroids]
        best = max(cosines)
        assert math.isclose(best, r.score, abs_tol=1e-3)
        near = {model.languages[model.of[i]] for i, c in enumerate(cosines) if c > best - 1e-3}
        assert r.lang_pred in near
        floor = model.floors[sum(len(r.text.encode()) > x for x in langid.LENGTHS)]
        if abs(best - floor) > 1e-3:
            assert r.rejected == (best < floor)


def test_every_centroid_is_of_unit_length(fitted):
    _, model = fitted
    for c in model.centroids:
        assert math.isclose(sum(float(x) ** 2 for x in c), 1.0, rel_tol=1e-3)


@pytest.mark.parametrize("text", ["Banana  bandana, naïve", "a", " x ", "ab\n\ncd 123"])
def test_counted_grams_equal_plain_ones(text):
    found = langid.counts([text.encode()])[0]
    assert {i: int(x) for i, x in enumerate(found) if x} == plain_counts(text.encode())


# --- nothing in, nothing out; very long texts


def test_empty_tables_and_long_texts(fitted, spark):
    docs, model = fitted
    assert langid.identify(docs.limit(0), model, "doc_id").count() == 0
    assert pii.pseudonymise(docs.select("doc_id", "text").limit(0)).count() == 0
    assert langid.fit(docs.limit(0)).languages == []
    long = " ".join(r.text for r in docs.limit(60).collect()) * 20
    (row,) = langid.identify(spark.createDataFrame([(1, long)], "doc_id bigint, text string"), model, "doc_id").collect()
    assert row.lang_pred in model.languages and 0 <= row.score <= 1


# --- passages

LONG = "doc_id bigint, text string"


def words_in(rng, n, size=30_000):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def shared_windows(texts, width):
    """(document, place) of every window of so many words that an earlier document has."""
    seen, found = {}, []
    for i, text in enumerate(texts):
        windows = [tuple(text[a : a + width]) for a in range(len(text) - width + 1)]
        found += [(i, a) for a, w in enumerate(windows) if seen.get(w, i) < i]
        for w in windows:
            seen.setdefault(w, i)
    return found


def test_every_exact_passage_is_found(spark):
    """Every run of 51 words that a document has with an earlier one lies in a reported passage, but for
    the two words by which neighbouring chains of a pair may cut each other short."""
    rng = random.Random(21)
    pool = [words_in(rng, rng.randrange(51, 90)) for _ in range(6)]
    texts = []
    for _ in range(90):
        text = words_in(rng, rng.randrange(0, 60))
        for cut in rng.sample(pool, rng.randrange(4)):  # no text begins a passage twice
            a = rng.choice([0, 0, rng.randrange(0, len(cut) - 20)])
            text += cut[a : a + rng.randrange(15, 90)] + words_in(rng, rng.randrange(40))
        texts.append(text)
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], LONG)
    got = {}
    for r in chaining.passages(df).collect():
        before = len(texts[r.doc_id]) and len(" ".join(texts[r.doc_id])[: r.start].split())
        got.setdefault(r.doc_id, []).append((before, before + r.n_words))
    wanted = shared_windows(texts, 51)
    assert len({i for i, _ in wanted}) > 20
    lost = [(i, a) for i, a in wanted if not any(min(y, a + 51) - max(x, a) >= 49 for x, y in got.get(i, []))]
    assert not lost, [(i, a, got.get(i)) for i, a in lost]


def test_a_passage_whose_parts_stand_in_many_documents(spark):
    """Documents C and D share 60 words; 56 documents before C and 56 between them have 12 each."""
    rng = random.Random(4)
    passage = words_in(rng, 60)

    def part():
        a = rng.randrange(0, 49)
        return words_in(rng, 40) + passage[a : a + 12] + words_in(rng, 40)

    texts = [part() for _ in range(56)] + [words_in(rng, 50) + passage + words_in(rng, 50)]
    texts += [part() for _ in range(56)] + [words_in(rng, 30) + passage + words_in(rng, 30)]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], LONG)
    rows = [r for r in chaining.passages(df).collect() if r.doc_id == 113]
    assert [(r.ref_doc_id, r.n_words) for r in rows if r.n_words >= 55] == [(56, 60)]


def test_unresolved_stretches():
    at = np.arange(0, 80, 6)
    n = np.array([5, 9, 2, 9, 9, 9, 9, 9, 3, 9, 9, 9, 9, 9])
    none = np.zeros(0, np.int64)
    assert chaining.unresolved(at, n, none, none).tolist() == [2, 8]
    assert chaining.unresolved(at, n, np.array([0]), np.array([90])).tolist() == []
    assert chaining.unresolved(at[:4], n[:4], none, none).tolist() == []
    assert chaining.unresolved(np.concatenate([at[:5], at[5:] + 20]), n, none, none).tolist() in ([8], [8, 9])


def test_blocks_that_cannot_grow_are_left_out(spark, monkeypatch):
    """No block is left out that leads to a passage, and pairs with a phrase in common are not aligned."""
    rng = np.random.default_rng(8)
    grown = left = 0
    for _ in range(600):
        alike = rng.random() * 1.1
        a = rng.integers(0, 40, 200).astype(np.uint64) << np.uint64(48)
        b = np.where(rng.random(200) < alike, a, rng.integers(0, 40, 200).astype(np.uint64) << np.uint64(48))
        p, n = int(rng.integers(0, 190)), int(rng.integers(5, 10))
        r = int(rng.integers(0, p + 1)) if alike < 0.5 else p
        b = b[p - r :].copy()
        b[r : r + n] = a[p : p + n]
        around = list(zip(chaining._around(p, n, a), chaining._around(r, n, b)))
        may = chaining.may_grow(n, *around)
        passage = bool(chaining.aligned([(p, r, min(n, 200 - p))], a, b))
        assert may or not passage
        grown, left = grown + passage, left + (not may)
    assert grown > 50 and left > 50

    plain, sent = chaining._aligned, []

    def aligned(pairs):
        sent.append({(r.doc, r.ref) for r in pairs.select("doc", "ref").collect()})
        return plain(pairs)

    monkeypatch.setattr(chaining, "_aligned", aligned)
    own = random.Random(3)
    phrase, passage = words_in(own, 7), words_in(own, 70)
    texts = [words_in(own, 90) + phrase + words_in(own, 90) for _ in range(8)]
    texts += [words_in(own, 30) + passage + words_in(own, 30) for _ in range(2)]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], LONG)
    assert [(r.doc_id, r.ref_doc_id, r.n_words) for r in chaining.passages(df).collect()] == [(9, 8, 70)]
    assert sent == [{(9, 8)}]


def test_texts_of_sieved_pairs_stay_out_of_python(spark):
    rng = np.random.default_rng(3)
    texts = {d: " ".join(f"w{x}" for x in rng.integers(0, 60, 200)) for d in range(6)}
    texts[5] = " ".join(texts[0].split()[:120] + ["odd"] * 60)
    words = {d: words_of([t.encode()]).hashes for d, t in texts.items()}
    places = [(0, 0, 5), (4, 150, 5), (100, 64, 8), (195, 195, 5), (70, 70, 20)]
    lone = [(d, r, [list(p)]) for d in range(1, 6) for r in range(d) for p in [places[(d + r) % 5]]]
    several = [(9, 8, [[0, 0, 5], [9, 9, 5]]), (9, 7, [[0, 0, 5, 7, 7, 5]])]
    chains = spark.createDataFrame(lone + several, "doc bigint, ref bigint, blocks array<array<int>>")
    own = spark.createDataFrame([*texts.items()], "doc bigint, text string")
    found = chaining._sieved(chains, own)

    def may(d, r, p, q, n):
        return chaining.may_grow(n, *zip(chaining._around(p, n, words[d]), chaining._around(q, n, words[r])))

    want = [x for x in lone if may(x[0], x[1], *x[2][0])]
    assert 0 < len(want) < len(lone)
    assert sorted((r.doc, r.ref, r.blocks) for r in found.collect()) == sorted(want + several)
    # Batches of texts, one for every pair, filled the executors' memory.
    lines = [line for line in found._jdf.queryExecution().analyzed().toString().splitlines() if "MapInArrow kept(" in line]
    assert lines and not any("text#" in line.partition("kept(")[2].partition(")#")[0] for line in lines)


def test_places_of_a_seed_that_recurs_are_listed_not_paired(spark):
    # A stretch of seeds that all occur elsewhere; the rarest, 7, recurs in it.
    rows = [(1, int(at), 7 if k % 2 else 8, 3 if k % 2 else 9) for k, at in enumerate(range(0, 80, 4))]
    shared = spark.createDataFrame(rows, "doc bigint, at int, seed bigint, n bigint")
    none = spark.createDataFrame([], "doc bigint, ref bigint, blocks array<array<int>>")
    found = chaining._asked(shared, none).collect()
    assert [(r.doc, r.seed) for r in found] == [(1, 7)] and len(found[0].ats) > 3

    ats, places = found[0].ats, [3, 9, 30, 57, 90]
    listed = [(2, 1, [5], [5]), (1, 0, ats, places), (1, 0, [100], [100]), (3, 1, [5, 6], [5, 6])]
    single = [(d, r, [a], [p]) for d, r, x, y in listed for a in x for p in y]
    kind = "doc bigint, ref bigint, ats array<int>, places array<int>"
    chains = [sorted(map(str, chaining._chained(spark.createDataFrame(x, kind)).collect())) for x in (listed, single)]
    assert chains[0] == chains[1] and len(chains[0]) == 3


def test_chains_are_sifted_without_loss():
    """No chain is left out that leads to a passage; many that lead to none are."""
    rng = np.random.default_rng(12)
    passages = left = barren = 0
    for k in range(500):
        a = rng.integers(0, 300, 260).astype(np.uint64)
        b = rng.integers(0, 300, int(rng.integers(60, 260))).astype(np.uint64)
        p, n = int(rng.integers(0, 120)), int(rng.integers(5, 60))
        r = int(rng.integers(0, len(b) - n + 1))
        b[r : r + n] = a[p : p + n]
        if k % 3 == 0:  # changed words, and a second run behind a gap
            for x in range(p + n, min(len(a), p + n + 80)):
                if 0 <= r + x - p < len(b) and rng.random() < 0.9:
                    b[r + x - p] = a[x]
        chain = [(p, r, 5)] if k % 2 else [(p, r, 5), *([(p + n - 5, r + n - 5, 5)] if n >= 10 else [])]
        sides = chaining.Fertile(a, b, chaining.LEAST), chaining.Fertile(b, a, 40)
        (q, s, m), found = chain[-1], chaining.aligned(chain, a, b)
        may = sides[0].reached(p, q + m) and sides[1].reached(r, s + m)
        assert may or not found
        passages, left, barren = passages + bool(found), left + (not may), barren + (not found)
    assert passages > 100 and left > 100 and barren > left


def test_blocks_of_a_chain_meet_over_equal_words(monkeypatch):
    """Two like texts are one block: between their kept seeds nothing is sought."""
    rng = np.random.default_rng(4)
    a = rng.integers(0, 1 << 60, 900).astype(np.uint64)
    b = a.copy()
    b[450] = 7
    at = chaining.winnowed(rolling_hashes(a, chaining.SEED))
    at = at[(at + chaining.SEED <= 450) | (at > 450)]
    (chain,) = chaining.chains_of(chaining.blocks_of(at, at))
    first, end = chain[0][0], chain[-1][0] + chain[-1][2]
    assert len(chain) > 20 and chaining.met(chain, a, b) == [(first, first, 450 - first), (451, 451, end - 451)]
    shifted = [(0, 0, 5), (8, 12, 5)]
    assert chaining.met(shifted, a[:20], np.concatenate([a[:6], b[100:105], a[7:20]])) == [(0, 0, 6), (7, 11, 6)]

    plain, sought = chaining._dense, []
    monkeypatch.setattr(chaining, "_dense", lambda x, *rest: sought.append(len(x)) or plain(x, *rest))
    assert [x[:4] for x in chaining.aligned(chain, a, b)] == [(0, 900, 0, 900)]
    assert len(sought) < 10


def test_many_pairs_at_once_as_one_by_one():
    """Blocks, seeds of a gap and blocks that may grow, worked out for many at once, equal the plain ones."""
    rng = np.random.default_rng(11)
    pair = np.sort(rng.integers(0, 40, 900))
    at, ref = rng.integers(0, 60, 900), rng.integers(0, 60, 900)
    owner, blocks = chaining._blocks_of_pairs(pair, at, ref)
    for k in range(40):
        mine = pair == k
        assert list(map(tuple, blocks[owner == k].tolist())) == chaining.blocks_of(at[mine], ref[mine])

    def told(words):
        last = {}
        for at in range(len(words) - chaining.SHORT + 1):
            run = tuple(words[at : at + chaining.SHORT].tolist())
            before, number = last.get(run, (-chaining.LEAST, -1))
            last[run] = at, number + 1 if at - before < chaining.LEAST else 0
            yield run, last[run][1]

    def plain(a, b):
        x, y = list(told(a)), list(told(b))
        found = [(i, j) for i in range(len(x)) for j in range(len(y)) if x[i] == y[j]]
        return chaining.blocks_of(*map(np.array, zip(*found)), chaining.SHORT) if found else []

    for k in range(300):
        words = [3, 20, 1000][k % 3]
        a = rng.integers(0, words, int(rng.integers(3, 90))).astype(np.uint64)
        b = np.where(rng.random(len(a)) < 0.8, a, rng.integers(0, words, len(a)).astype(np.uint64))[int(rng.integers(0, 3)) :]
        assert chaining._dense(a, b, 0, 0) == plain(a, b)

    rows = []
    for k in range(600):
        sides = []
        for _ in range(2):
            size = [int(x) for x in rng.choice([0, 1, 3, 40, 64], 2)]
            a, b = (rng.integers(0, [6, 5000][k % 2], x).astype("<u2") for x in size)
            like = rng.random(min(size)) < 0.95
            b[: min(size)][like] = a[: min(size)][like]
            sides.append((a, b))
        rows.append((int(rng.integers(5, 30)), *sides))
    want = [chaining.may_grow(*row) for row in rows]
    columns = [[row[k][j][:: -1 if k == 1 else 1].tobytes() for row in rows] for k in (1, 2) for j in (0, 1)]
    before, ref_before, behind, ref_behind = (pa.array([b""] + x, pa.binary()).slice(1) for x in columns)
    found = chaining._may_grow(np.array([row[0] for row in rows]), [(before, ref_before, True), (behind, ref_behind, False)])
    assert found.tolist() == want and 50 < sum(want) < 550


def test_seeds_of_texts_taken_together(spark):
    """The seeds of a document do not depend on those beside it."""
    own = random.Random(9)
    texts = [" ".join(words_in(own, k)) for k in (49, 50, 200, 0, 51, 300)] + ["a b c d e " * 40, "a b c d e " * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "doc bigint, text string").coalesce(1)
    together = sorted(map(tuple, chaining._seeds(df).collect()))
    alone = [tuple(r) for d in range(len(texts)) for r in chaining._seeds(df.where(f"doc = {d}")).collect()]
    assert together == sorted(alone) and {r[0] for r in together} == {1, 2, 4, 5, 6, 7}
    hashes = rolling_hashes(words_of([texts[5].encode()]).hashes, chaining.SEED)
    plain = [min(range(i, i + chaining.WINDOW), key=lambda k: (hashes[k], k)) for i in range(len(hashes) - chaining.WINDOW + 1)]
    assert sorted(r[2] for r in together if r[0] == 5) == sorted(set(plain)) == chaining.winnowed(hashes, step=50).tolist()


def test_links_over_all_tasks_equal_plain_ones(spark):
    """Each document of a shared seed: its places, the seed's count, its first place and the last one before."""
    own = random.Random(6)
    rows = sorted({(own.choice([1, 1, 1, 1, 2, 3, 4]), own.random() < 0.2, own.randrange(60), own.randrange(9)) for _ in range(500)} | {(9, False, 5, 1), (9, False, 5, 3)})
    rows = [(s, p, d, a) for s, p, d, a in rows if not p or any(x[:3] == (s, False, d) for x in rows)]
    want = []
    for s, p, d in sorted({r[:3] for r in rows}):
        mine, told = [r for r in rows if r[0] == s], [r for r in rows if r[:2] == (s, False)]
        if len({r[2] for r in mine}) > 1:
            first = told[0][2:] if not p and told[0][2] < d else (None, None)
            before = max([r[2:] for r in told if r[2] < d and not p], default=None)
            before = (None, None) if before in (None, first) else before
            want.append((s, d, [r[3] for r in mine if r[1:3] == (p, d)], p, len(mine), *first, *before))
    frame = spark.createDataFrame(rows, "seed bigint, plain boolean, doc bigint, at int").repartition(5)
    found = chaining._linked(frame)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    tasks = {f for (f,) in spark.read.parquet(*found.inputFiles()).where("edge = 1 AND seed = 1").select("_metadata.file_name").distinct().collect()}
    assert len(tasks) > 1  # the frequent seed is not in one task


def test_chains_go_on_from_their_blocks(spark):
    """Chains found from those of fewer matches are the chains of all matches."""
    rng = np.random.default_rng(5)
    kind = "doc bigint, ref bigint, ats array<int>, places array<int>"
    some, more = ([(int(d), int(r), [int(a)], [int(a) + int(x)]) for d, r, a, x in zip(*(rng.integers(0, k, n) for k in (3, 2, 300, 4)))] for n in (700, 90))
    more = [m for m in more if m[:2] != (0, 0)]
    some, more = (spark.createDataFrame(x, kind) for x in (some, more))
    had = chaining._chained(some).selectExpr("doc", "ref", "CAST(NULL AS array<int>) ats", "CAST(NULL AS array<int>) places", "blocks")
    again = chaining._chained(had.union(more.selectExpr("*", "CAST(NULL AS array<array<int>>) blocks")))
    want = sorted(map(str, chaining._chained(some.union(more)).collect()))
    assert sorted(map(str, again.collect())) == want and len(want) == 6


class Given:
    """Stands for a frame whose function is called without Spark."""

    def mapInArrow(self, run, kind):
        return run


def test_pairs_are_aligned_together(monkeypatch):
    """Pairs aligned at once give what each gives alone; the work is not begun anew for every chain."""
    own = random.Random(15)
    rows = []
    for k in range(120):
        a = words_in(own, own.randrange(60, 260))
        b = [w if own.random() > [0, 0.05, 0.1, 0.18][k % 4] else "other" for w in a][own.randrange(9) : own.randrange(70, 300)]
        b = words_in(own, own.randrange(50)) + b + words_in(own, own.randrange(50))
        if k % 5 == 0:
            a, b = a + words_in(own, 90) + a[:70], b + words_in(own, 20) + a[-60:]
        one, other = ("é " * (k % 3) + " ".join(x) for x in (a, b))
        x, y = (words_of([t.encode()]).hashes for t in (one, other))
        found = [(i, j) for i in range(0, len(x) - 4, 3) for j in range(len(y) - 4) if (x[i : i + 5] == y[j : j + 5]).all()]
        if found:
            chains = chaining.chains_of(chaining.blocks_of(*map(np.array, zip(*found))))
            rows.append((k, 1000 + k, [[v for block in c for v in block] for c in chains], one, other))
    kind = pa.schema([*chaining._CHAINS, ("text", pa.string()), ("ref_text", pa.string())])
    batch = pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), kind)], schema=kind)
    run = chaining._aligned(Given())
    alone = [r for i in range(len(rows)) for out in run(iter([batch.slice(i, 1)])) for r in out.to_pylist()]
    plain, called = chaining.short_runs, []
    monkeypatch.setattr(chaining, "short_runs", lambda words: called.append(len(words)) or plain(words))
    together = [r for out in run(iter([batch])) for r in out.to_pylist()]
    assert together == alone and len(together) > 80 and len(called) <= 4
    texts = {k: (one, other) for k, _, _, one, other in rows}
    for r in together:
        one, other = (words_of([t.encode()]).hashes for t in (texts[r["doc_id"]][0][r["start"] : r["end"]], texts[r["doc_id"]][1][r["ref_start"] : r["ref_end"]]))
        assert len(one) == r["n_words"] >= chaining.LEAST and set(one[[0, -1]]) <= set(other) and r["identity"] >= chaining.IDENTITY


def test_stored_tables_leave_no_shuffled_rows(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {b for b in disk.getAllBlocks().mkString(" ").split() if b.startswith("shuffle_")}

    before = shuffled()
    frame = spark.range(1000).repartition(3, "id")
    kept = stored(frame, "left")
    for _ in range(100):
        if shuffled() <= before:
            break
        time.sleep(0.1)
    assert shuffled() <= before
    assert kept.count() == frame.count() == 1000  # computed again
