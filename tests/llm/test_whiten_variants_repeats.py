"""Whitening, spelling variants and repeated substrings against brute force, and on the defined cases."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskspark.llm import repeats, variants, whiten

DOCS = "doc_id long, text string, lang string, block long, word string, n long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", 1, "w", 2) for i, t in rows], DOCS).repartition(3)


# --- whitening ---


def expected_whitening(vectors, k):
    x = np.full((len(vectors), max(map(len, vectors))), 100_000.0)
    for row, v in zip(x, vectors, strict=True):
        row[: len(v)] = np.floor(1024 * np.array(v, float)) + 100_000
    y = x - x.mean(0)
    values, basis = np.linalg.eigh(y.T @ y / len(x))
    values, basis = values[::-1][:k], basis[:, ::-1][:, :k]
    whole = x.astype(np.int64).astype(object)
    deviation = ((len(x) * whole - whole.sum(0)) ** 2).sum(1)
    return values, y @ basis / np.sqrt(values), deviation, values / np.trace(y.T @ y / len(x))


def test_whitening_matches_dense_algebra(spark):
    rng = np.random.default_rng(5)
    vectors = [v.tolist() for v in rng.standard_normal((300, 12)) * rng.uniform(0.1, 4, 12)] + [[1.0, 2.0], []]
    rows = list(enumerate(vectors)) + [(5, [float("nan")] * 12), (6, None), (7, [1.0, None]), (8, [float("inf")]), (None, vectors[3]), (3, vectors[3])]
    df = spark.createDataFrame([(i, v, i, 1.0) for i, v in rows], "vec_id long, vector array<float>, component long, n double").repartition(4)
    used = vectors + [vectors[3]] * 2
    values, projected, deviation, explained = expected_whitening([np.float32(v).tolist() for v in used], 8)
    got = whiten.whitened(df.select("vec_id", "vector")).toPandas()
    assert len(got) == 8 * len(used) and set(got["n"]) == {len(used)}
    assert got["identity_error"].nunique() == 1 and got["identity_error"].max() < 1e-9
    for k in range(8):
        own = got[got["component"] == k + 1].sort_values("vec_id", na_position="last")
        own = own[own["vec_id"].notna()].drop_duplicates("vec_id").set_index("vec_id")
        want = projected[: len(vectors), k]
        mine = own.loc[range(len(vectors)), "whitened"].to_numpy()
        assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < 1e-8
        assert own.loc[range(len(vectors)), "deviation"].tolist() == deviation[: len(vectors)].tolist()
        assert abs(own["explained"].iloc[0] / explained[k] - 1) < 1e-9


def test_whitening_of_large_equal_and_flat_vectors(spark):
    schema = "vec_id long, vector array<double>"
    same = whiten.whitened(spark.createDataFrame([(k, [1.0, 2.0]) for k in range(5)], schema)).toPandas()
    assert len(same) == 10 and same["whitened"].isna().all() and set(same["deviation"]) == {0} and set(same["identity_error"]) == {0.0}
    large = whiten.whitened(spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 1e9])], schema)).toPandas()
    assert len(large) == 6 and large["deviation"].isna().any()
    line = whiten.whitened(spark.createDataFrame([(k, [float(k), 2.0 * k, 0.0]) for k in range(9)], schema)).toPandas()
    assert line[line["component"] == 1]["whitened"].notna().all() and line[line["component"] > 1]["whitened"].isna().all()
    assert line["identity_error"].max() < 1e-9
    assert whiten.whitened(spark.createDataFrame([], schema)).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=1, max_size=9), st.integers(0, 2**31))
def test_slicing_numbers_equal_and_zero_eigenvalues(values, seed):
    d = len(values)
    turn = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))[0]
    a = turn @ np.diag(np.array(values, float)) @ turn.T
    a = (a + a.T) / 2
    found, basis = whiten.leading(a, min(4, d))
    assert np.allclose(found, sorted(values, reverse=True)[:4], atol=1e-12)
    assert np.allclose(basis.T @ basis, np.eye(len(found)), atol=1e-12) and np.allclose(a @ basis, basis * found, atol=1e-11)
    for cut in (0.5, 3.5, 6.5):
        assert whiten.negative_pivots(a, cut) == sum(v < cut for v in values)


# --- spelling variants ---


def expected_words(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                count[run] += 1
    return {w: n for w, n in count.items() if n >= 2}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(a == b[:k] + b[k + 1 :] for k in range(len(b)))


def expected_variants(words):
    near = {w: [] for w in words}
    for a, b in itertools.combinations(sorted(words), 2):
        if abs(len(a) - len(b)) < 2 and one_apart(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o.encode()), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), words[w], len(near[w]), None if form[w] is None else words[form[w]]) for w in words)


def test_words_and_variants_match_brute_force(spark):
    rnd = random.Random(4)
    stems = ["Versicherung", "nación", "straßenbahn", "Éducation", "aaaaaaa", "committee", "×÷letters"]
    rows = []
    for k in range(400):
        words = []
        for _ in range(30):
            w = rnd.choice(stems)
            if rnd.random() < 0.2:
                p = rnd.randrange(len(w))
                w = rnd.choice([w[:p] + w[p + 1 :], w[:p] + rnd.choice("aeà") + w[p:], w[:p] + rnd.choice("aeà") + w[p + 1 :]])
            words.append(w if rnd.random() < 0.8 else w.upper())
        rows.append((k, " ".join(words)))
    rows += [(None, rows[0][1]), (3, rows[3][1]), (900, None), (901, ""), (902, "12 3456 abc"), (903, "z" * 30_000 + " " + "z" * 30_001), (904, "z" * 30_000 + " " + "z" * 30_001)]
    words = expected_words(rows)
    assert any(w.startswith("zzz") for w in words)
    got = variants.variants(variants.word_counts(docs_of(spark, rows))).collect()
    assert sorted(tuple(r) for r in got) == expected_variants(words)


def test_variants_of_dense_words_and_chains(spark):
    rnd = random.Random(5)
    words = {"".join(rnd.choice("ab") for _ in range(rnd.randint(1, 9))): rnd.choice([1, 2, 9, 10, 30, 99, 100, 4000]) for _ in range(400)}
    words |= {"chainword": 2, "chainwors": 20, "chainwort": 200, "chainwo": 5}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert sorted(tuple(r) for r in variants.variants(df).collect()) == expected_variants(words)


def test_variants_where_one_node_is_dealt_into_parts(spark, monkeypatch):
    monkeypatch.setattr(variants, "PART", 3)
    rnd = random.Random(6)
    words = {"prefix" + "".join(rnd.choice("abc") for _ in range(rnd.randint(3, 5))): rnd.randint(1, 50) for _ in range(200)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert sorted(tuple(r) for r in variants.variants(df).collect()) == expected_variants(words)


def test_variants_of_an_empty_table(spark):
    assert variants.variants(variants.word_counts(docs_of(spark, []))).count() == 0


# --- repeated substrings ---


def expected_repeats(rows):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, words in split:
        for s in range(len(words) - 19) if i is not None else ():
            key = tuple(words[s : s + 20])
            first[key] = min(first.get(key, (i, s)), (i, s))
    out = []
    for i, words in split:
        gone = set()
        for s in range(len(words) - 19) if i is not None else ():
            if first[tuple(words[s : s + 20])] < (i, s):
                gone.update(range(s, s + 20))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def repeating():
    rnd = random.Random(9)
    fresh = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    passage, line = fresh(70), fresh(20)
    rows = []
    for k in range(150):
        words = fresh(rnd.randint(0, 60))
        if k % 3 == 0:
            words += passage[rnd.randrange(20) : rnd.randint(50, 70)] + fresh(5)
        if k % 4 == 0:
            words += line * rnd.randint(1, 3) + fresh(2)
        rows.append((k, rnd.choice([" ", "\n", "\x0b\t "]).join(words)))
    rows += [(200 + k, rows[9][1]) for k in range(20)]  # copies
    rows += [(230, rows[9][1].replace(" ", "  ")), (9, rows[9][1]), (240, "same " * 500), (241, "same " * 30), (242, "same " * 19)]
    rows += [(250, None), (251, ""), (252, " ".join(passage)), (None, rows[0][1]), (None, " ".join(passage)), (260, " ".join(fresh(3000) + passage))]
    return rows


@pytest.mark.parametrize("block_bytes", [1, 2_000, 8_000_000])
def test_removed_words_match_brute_force(spark, repeating, block_bytes):
    got = repeats.without_repeats(docs_of(spark, repeating), block_bytes=block_bytes).collect()
    assert sorted(map(tuple, got), key=str) == expected_repeats(repeating)


@pytest.mark.parametrize("per_window", [8, 0.01])
def test_a_small_sketch_loses_nothing(spark, repeating, per_window):
    """With a cell for a hundred windows everything is estimated repeated, and still settled exactly."""
    got = repeats.without_repeats(docs_of(spark, repeating), block_bytes=3_000, cells_per_window=per_window, shard_bits=4, part_windows=100).collect()
    assert sorted(map(tuple, got), key=str) == expected_repeats(repeating)


def test_kept_text_and_rows_that_share_a_doc_id(spark):
    rnd = random.Random(2)
    a, b = ([f"{c}{rnd.randrange(10**6)}" for _ in range(40)] for c in "ab")
    rows = [(1, " ".join(a)), (1, " ".join(a)), (1, " ".join(b + a)), (2, " ".join(["x"] + b))]
    got = repeats.without_repeats(docs_of(spark, rows), with_text=True, block_bytes=1).toPandas()
    for _, row in got.iterrows():
        assert hashlib.sha256(row["kept"].encode()).hexdigest() == row["kept_sha256"]
    kept = sorted(zip(got["doc_id"], got["kept"], strict=True))
    assert kept == sorted([(1, " ".join(a)), (1, " ".join(a)), (1, " ".join(b)), (2, "x")])


def test_repeats_of_an_empty_table(spark):
    assert repeats.without_repeats(docs_of(spark, [])).count() == 0


@given(st.text(alphabet="ab \n\x0b\u2003\xa0", max_size=80), st.integers(1, 20))
def test_pieces_are_the_words(text, size):
    found = [w.decode() for piece in repeats.pieces(text.encode(), size) for w in piece]
    assert found == re.findall(r"[^\x20\x09-\x0D]+", text)


def test_registered_queries_on_the_given_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert sorted(map(tuple, repeats.op13_substring_dedup(spark, sf).collect()), key=str) == expected_repeats(rows)
    words = expected_words(rows)
    counted = {r["word"]: r["n"] for r in variants.op12_spelling_variants(spark, sf).collect()}
    assert counted == words
    n = spark.read.parquet(f"{sf}/embeddings.parquet").where(F.col("embedding").isNotNull()).count()
    assert whiten.op11_whitening(spark, sf).count() == 8 * n
