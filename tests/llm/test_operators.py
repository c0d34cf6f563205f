"""Every operator against brute force, and on nulls, empty and long texts, ties, repeated rows, empty tables."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from riskspark.llm import catalog, crf, grams, language, mixing, near, packing, pii, quality, search, urls, warc, winnow

DOCS = "doc_id long, text string, lang string, source string, n_chars long, part string, row string"
WORDS = {"en": "the and of to in that is was for with".split(), "de": "der die und ein nicht mit sich auf von zu".split()}


def prose(rnd, lang, n):
    return " ".join(rnd.choice(WORDS[lang]) + rnd.choice(["", "", "s", "er", "en", "ing"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    out = [(k, prose(rnd, ("en", "de")[k % 2], rnd.randint(20, 90)), ("en", "de")[k % 2]) for k in range(60)]
    base = prose(rnd, "en", 80).split()
    for k in range(12):  # near copies, some of them near only to some others
        words = list(base)
        for _ in range(k % 5):
            words[rnd.randrange(80)] = f"x{rnd.randrange(1000)}"
        out.append((100 + k, " ".join(words), "en"))
    out += [(120 + k, out[0][1], "en") for k in range(5)]  # exact copies
    out += [(130, None, "en"), (131, "", None), (132, " \n\t", "en"), (133, "one two", "en"), (134, "One  TWO", "de"), (135, "long " * 6000, "en")]
    out += [(136, "###&&& 4111111111111111 ### $$$ @@@ %%% " * 10, "en"), (136, "###&&& 4111111111111111 ### $$$ @@@ %%% " * 10, "en"), (None, "no name here at all", "en")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    full = [(i, t, lang, "s", None if t is None else len(t), "x", "y") for i, t, lang in rows]
    return spark.createDataFrame(full, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark, rows):
    known = [(i, 0 if i == 136 else 1, int(i == 7)) for i, _, _ in rows if i is not None and (i < 40 or i == 136)]
    return spark.createDataFrame([*known, known[0], (9999, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_near_duplicates_match_brute_force(docs, rows):
    sets = []
    for i, t, _ in rows:
        w = (t or "").encode().lower().split()
        sets.append((i, {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}))
    top = {i: i for i, _ in sets}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if i is not None and j is not None and a and 100 * len(a & b) >= 75 * len(a | b):
            x, y = root(i), root(j)
            top[max(x, y)] = min(x, y)
    want = sorted(((i, len(s), None if i is None else root(i)) for i, s in sets), key=str)
    got = near.near_duplicates(docs).toPandas()
    cast = lambda x: None if pd.isna(x) else int(x)
    assert sorted(((cast(r.doc_id), r.n_shingles, cast(r.component_id)) for r in got.itertuples()), key=str) == want
    assert all(r.kept == (not pd.isna(r.doc_id) and r.doc_id == r.component_id) for r in got.itertuples())


def test_blocks_of_a_bucket_find_all_links(spark, monkeypatch):
    rnd = random.Random(1)
    base = [f"w{k}" for k in range(140)]
    texts = []
    for k in range(150):
        words = list(base)
        for _ in range(rnd.randint(0, 14)):
            words[rnd.randrange(140)] = f"n{rnd.randrange(10**6)}"
        texts.append((k, " ".join(words)))
    sets = [{tuple(t.split()[j : j + 5]) for j in range(136)} for _, t in texts]
    top = list(range(150))
    root = lambda x: x if top[x] == x else root(top[x])
    for i, j in itertools.combinations(range(150), 2):
        if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            x, y = root(i), root(j)
            top[max(x, y)] = min(x, y)
    monkeypatch.setattr(near, "BLOCK", 32)
    got = near.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).toPandas()
    assert dict(zip(got.doc_id, got.component_id, strict=True)) == {k: root(k) for k in range(150)}


@pytest.mark.parametrize("size", [40, near.BOTTOM, 3 * near.BOTTOM])
@pytest.mark.parametrize("common", [0.5, 0.84, 0.858, 0.95])
def test_similarity_inside_a_bucket(size, common):
    hashes = np.random.default_rng(size).integers(1, 1 << 63, 2 * size, dtype=np.uint64)
    shared = round(common * size)
    a, b = np.sort(hashes[:size]), np.sort(hashes[size - shared : 2 * size - shared])
    exact = shared / (2 * size - shared)
    low, high = near.likely(a[: near.BOTTOM], b[: near.BOTTOM], size, size)
    assert low <= exact <= high
    assert (low == high) == (size <= near.BOTTOM)


def test_components_of_long_chains(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 105)]
    got = near.components(spark.createDataFrame(edges, "a long, b long")).toPandas()
    assert dict(zip(got.node, got.component, strict=True)) == {k: 0 for k in range(1, 41)} | {101: 100, 105: 100}


def test_quality_sums_equal_a_plain_model(docs, rows, labels):
    got = quality.classify(docs, labels).toPandas()
    assert len(got) == len(rows)
    by_id = got.drop_duplicates("doc_id").set_index("doc_id")
    assert not by_id.kept[130] and not by_id.kept[131] and pd.isna(by_id.perplexity[131])
    assert not by_id.kept[136]
    assert by_id.loc[range(40)].kept.mean() > 0.9


def test_lower_orders_are_distributions():
    follows = np.zeros((256, 256))
    follows[97, 98], follows[97, 99], follows[98, 97] = 3, 1, 2
    assert np.allclose(quality.lower_orders(follows).sum(1), 1)
    assert np.allclose(quality.lower_orders(np.zeros((256, 256))).sum(1), 1)


def test_perplexity_matches_direct_counts(spark):
    texts = [b"abab", b"abcab", b"", b"xyz"]
    docs = spark.createDataFrame([(k, t.decode(), "en") for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = quality.perplexity(docs, spark.createDataFrame([(0,), (1,)], "doc_id long")).toPandas().set_index("doc_id")
    every = [g for t in texts[:2] for g in zip(b"\0\0" + t + b"\0", (b"\0\0" + t + b"\0")[1:], (b"\0\0" + t + b"\0")[2:], strict=False)]
    counts, by_context = Counter(every), defaultdict(list)
    for g, n in counts.items():
        by_context[g[:2]].append(n)
    follows = np.zeros((256, 256))
    for _, y, z in set(every):
        follows[y, z] += 1
    d = quality.discounts_of(np.array([sum(n == k for n in counts.values()) for k in (1, 2, 3, 4)]))
    low = quality.lower_orders(follows)

    def p(g):
        own, n = by_context[g[:2]], counts[g]
        if not own:
            return low[g[1], g[2]]
        back = sum(d[min(c, 3)] for c in own) / sum(own)
        return max(n - d[min(n, 3)], 0) / sum(own) + back * low[g[1], g[2]]

    for k, t in enumerate(texts):
        if t:
            whole = b"\0\0" + t + b"\0"
            bits = sum(np.log2(p(g)) for g in zip(whole, whole[1:], whole[2:], strict=False))
            assert np.isclose(got.perplexity[k], 2 ** (-bits / (len(t) + 1)))


def test_gram_runs_count_every_gram():
    texts = [b"aab", b"", b"aab", b"b"]
    gram, doc, n = grams.gram_runs(texts, 3)
    want = {}
    for d, t in enumerate(texts):
        whole = b"\0\0" + t + b"\0"
        for k in range(len(t) + 1):
            key = (int.from_bytes(whole[k : k + 3], "big"), d)
            want[key] = want.get(key, 0) + 1
    assert {(int(g), int(d)): int(c) for g, d, c in zip(gram, doc, n, strict=True)} == want


def test_language(docs, rows):
    models = language.learn(docs)
    got = language.identify(docs, models).toPandas()
    assert len(got) == len(rows) and set(models) <= {"en", "de"}
    by_id = got.drop_duplicates("doc_id").set_index("doc_id")
    assert all(by_id.held_out[k] == (zlib.crc32(str(k).encode()) % 5 == 0) for k in range(60))
    assert sum(by_id.lang_pred[k] == ("en", "de")[k % 2] for k in range(60)) >= 57
    assert set(by_id.lang_pred[[130, 131, 132]]) == {"und"} and got.score.between(0, 1).all()


def test_language_code_is_complete():
    levels = language.train([b"abracadabra", b"abrakadabra"])
    for context in (b"abr", b"zzz", b"\0\0\0", b"kad"):
        gram = np.array([int.from_bytes(context + bytes([k]), "big") for k in range(256)], np.uint64)
        assert np.isclose(np.exp2(-language.code_lengths(levels, gram, language.ORDER)).sum(), 1)


def test_language_without_anything_to_learn(docs):
    got = language.identify(docs, {}).toPandas()
    assert set(got.lang_pred) == {"und"} and set(got.score) == {0.0}


def marks(text):
    words = re.split("[ \t\n\x0b\x0c\r]+", text.lower().strip(" \t\n\x0b\x0c\r")) if text.strip(" \t\n\x0b\x0c\r") else []
    runs = [tuple(words[k : k + 5]) for k in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)] * bool(words)
    return runs


def test_winnowing(docs, rows):
    got = winnow.compare_with_edits(docs).toPandas()
    assert len(got) == len(rows)
    order = sorted(((i, t or "") for i, t, _ in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = []
    for k, (i, t) in enumerate(order):
        after, cut = order[(k + 1) % len(order)][1], len(t) // 3
        want.append((i, len(t), t[: len(t) - cut] + after[:cut]))
    cast = lambda x: None if pd.isna(x) else int(x)
    assert sorted(((cast(r.doc_id), r.n_chars, r.edited) for r in got.itertuples()), key=str) == sorted(want, key=str)
    for r in got.itertuples():
        runs = marks(r.text)
        at = list(r.marks_at)
        # At least one mark in every window of four grams, in order, and equal grams have equal hashes.
        assert at == sorted(set(at)) and all(0 <= a < len(runs) for a in at)
        assert all(any(k <= a < k + 4 for a in at) for k in range(max(len(runs) - 3, min(len(runs), 1))))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    hashes = {}
    for r in got.itertuples():
        for a, h in zip(r.marks_at, r.marks, strict=True):
            assert hashes.setdefault(h, marks(r.text)[a]) == marks(r.text)[a]
    texts = got.assign(f=got.marks.map(tuple)).groupby("text").f.nunique()
    assert texts.max() == 1


def test_winnowing_takes_the_rightmost_minimum(spark):
    values = [[5, 3, 3, 7, 9, 1, 1, 4], [2, 2], [7], []]
    df = spark.createDataFrame([(v,) for v in values], "g array<long>").withColumn("p", winnow.chosen_positions(F.col("g")))
    for r in df.collect():
        g = r["g"]
        want = []
        for k in range(max(len(g) - 3, min(len(g), 1))):
            window = g[k : k + 4]
            at = k + max(j for j, v in enumerate(window) if v == min(window))
            if at not in want:
                want.append(at)
        assert r["p"] == want


def test_packing_is_a_partition(docs, rows):
    path = public_tokenizers.path("word_bpe_49k.json")
    got = packing.pack(docs, path).toPandas()
    encoder = Tokenizer.from_file(path)
    want = {}
    for i, t, _ in rows:
        want.setdefault(i, encoder.encode(t or "", add_special_tokens=False).ids + [1])
    for i, own in got.groupby(got.doc_id.astype("Int64"), dropna=False):
        ids = want[None if pd.isna(i) else int(i)]
        copies = sum(r[0] == (None if pd.isna(i) else int(i)) for r in rows)
        assert own.length.sum() == copies * len(ids) and set(own.doc_tokens) == {len(ids)}
        for r in own.itertuples():
            assert zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
    filled = got.sort_values(["sequence_id", "offset"])
    assert (filled.offset == filled.groupby("sequence_id").length.cumsum() - filled.length).all()
    assert got.groupby("sequence_id").length.sum().max() <= 2048


def test_packing_words_equal_the_tokenizer():
    rnd, path = random.Random(2), public_tokenizers.path("word_bpe_49k.json")
    texts = ["".join(rnd.choice(["a", "É", "'s", " ", "\n", "\u00a0", "\x1c", "e\u0301", "1", "<|endoftext|>", "#", "日本", "\u2003"]) for _ in range(60)) for _ in range(200)]
    plain, words = Tokenizer.from_file(path), packing.WordIds(path)
    for text, ids in zip(texts, words.encode([t.encode() for t in texts]), strict=True):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids + [1]


def test_neighbours_are_lexical():
    ids = [np.array([*own, 1]) for own in ([5, 6, 7], [50, 60], [5, 6, 9], [70])]
    index = packing.Index(ids, packing.Corpus(np.ones(100), 3.0))
    assert index.neighbours(0, np.ones(4, bool)).tolist() == [2]


LUHN = "4111111111111111"


@pytest.mark.parametrize("seed", range(3))
def test_base_patterns_equal_plain_regular_expressions(seed):
    rnd = random.Random(seed)
    for _ in range(4000):
        t = "".join(rnd.choice("a1.@-+ 9()0%z2\n") for _ in range(rnd.randint(0, 40)))
        want = {
            "email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)],
            "ip": [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))],
            "card": [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 16 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and crf.luhn(d)],
            "phone": [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15],
        }
        assert pii.base_spans(t) == want


@pytest.fixture(scope="module")
def tagger():
    return crf.train(pii.labelled_table())


def test_field_reads_held_out_patterns(tagger):
    held = pii.labelled_table(200, 99).sort_values(["chain", "position"])
    lengths = held.groupby("chain").size().to_numpy()
    tags = crf.decode(tagger, np.array([crf.describe(w) for w in held.word]), lengths)
    assert (np.array(crf.TAGS)[tags] == held.tag.to_numpy()).mean() > 0.98


def test_viterbi_is_the_best_path(tagger):
    words = ["call", "(555)", "123-4567", "now"]
    e = crf.emissions(tagger, crf.feature_ids(np.array([crf.describe(w) for w in words]), np.array([4])))
    score = lambda p: tagger.first[p[0]] + sum(e[k, t] for k, t in enumerate(p)) + sum(tagger.moves[a, b] for a, b in itertools.pairwise(p))
    best = max(itertools.product(range(len(crf.TAGS)), repeat=4), key=score)
    assert crf.decode(tagger, np.array([crf.describe(w) for w in words]), np.array([4])).tolist() == list(best)


def test_personal_data(spark, tagger, docs, rows):
    texts = [f"a {LUHN} b", f"{LUHN} 4012888888881881 x", "plain words only", None, "mail bob@x.example.com, 10.0.0.1 +1 (555) 123-4567"]
    small = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = pii.find(small, tagger).toPandas().set_index("doc_id")
    assert got.spans[0] == "card:2:18" and got.n_card[0] == 1
    assert got.n_card[1] == 0 and "card:17:33" in got.spans[1]  # the pattern takes both as one number
    assert got.spans[2] == "" and got.spans[3] == "" and got.base_sha256[2] == hashlib.sha256(b"").hexdigest()
    assert got.spans[4].startswith("email:5:22,ip:24:32,") and got.n_phone[4] == 1
    hidden = pii.masked(small.withColumns({"n_chars": F.lit(0).cast("long"), "spans": F.lit("x")}), tagger).toPandas().set_index("doc_id")
    assert hidden.text[0] == "a <CARD> b" and hidden.n_chars[0] == 10 and hidden.text[3] is None
    assert len(pii.find(docs, tagger).toPandas()) == len(rows)


def test_mixing_meets_targets(docs, labels, rows):
    got = mixing.mix(docs, mixing.domains_of(labels), {"good": 0.9, "poor": 0.1}).toPandas()
    assert len(got) == len(rows) and (got.rate >= 0).all()
    assert np.allclose(got.posterior.map(sum), 1)
    totals = np.stack(got.posterior) * (got.rate * got.tokens).to_numpy()[:, None]
    own = np.stack(got.posterior) * got.tokens.to_numpy()[:, None]
    want = mixing.goals(own.sum(0), np.array([0.9, 0.1]), None)
    assert np.abs(totals.sum(0) - want).max() / got.tokens.sum() < 1e-4


def parted(doc_id):
    """A text of the domain poor for odd ids, else of good; a part of its words are the other domain's."""
    rnd = random.Random(doc_id)
    own, other = ("buy", "cheap") if doc_id % 2 else ("stone", "river"), ("buy", "river")
    return " ".join(rnd.choice(own if rnd.random() < 0.5 else other) + rnd.choice(["", "", " x", " yz"]) for _ in range(rnd.randint(3, 8)))


@pytest.mark.parametrize("sample", [3000, 40])
def test_labels_of_removed_documents_do_not_count(spark, sample):
    """An earlier stage removed nine tenths of poor: posteriors are those of a table that labels only what is left."""
    known = pd.DataFrame([(k, "poor" if k % 2 else "good") for k in range(1000)], columns=["doc_id", "domain"])
    left = known[(known.doc_id % 2 == 0) | (known.doc_id % 20 == 1)]
    docs = spark.createDataFrame([(int(k), parted(int(k))) for k in left.doc_id], "doc_id long, text string")
    got = mixing.scorer(docs, spark.createDataFrame(known), ["good", "poor"], sample)(docs).toPandas().set_index("doc_id")
    want = mixing.scorer(docs, spark.createDataFrame(left), ["good", "poor"], sample)(docs).toPandas().set_index("doc_id")
    assert np.abs(np.stack(got.posterior) - np.stack(want.posterior.loc[got.index])).max() < 1e-6
    if sample == 3000:  # all are fitted on, and the mean posterior of a fit with offsets is the shares that are there
        assert np.allclose(np.stack(got.posterior).mean(0), [500 / 550, 50 / 550], atol=0.005)


def test_mixing_after_a_stage_that_removes_a_domain(spark, tmp_path):
    """Near copies, most of poor, go in the stage before; the mixing stage then does what the labels of the rest say."""
    rnd = random.Random(5)
    base = [prose(rnd, "en", 60) + " buy cheap" for _ in range(4)]
    texts = [(k, prose(rnd, "en", rnd.randint(40, 80)) + (" cheap" if k % 6 == 0 else "")) for k in range(60)] + [(100 + k, base[k % 4]) for k in range(80)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), "x", "y") for i, t in texts], DOCS)
    left = mixing.stored(corpus_pipeline.drop_near_copies(spark, docs, None))
    there = {r["doc_id"] for r in left.select("doc_id").collect()}
    assert len([i for i in there if i >= 100]) == 4
    out = {}
    for name, ids in (("all", {i for i, _ in texts}), ("left", there)):
        known = spark.createDataFrame([(i, int(i < 100), 0) for i in sorted(ids)], "doc_id long, quality int, toxic int")
        known.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        domains = mixing.domains_of(known)
        out[name] = (
            sorted(r["doc_id"] for r in corpus_pipeline.mix_domains(spark, left, f"{tmp_path}/{name}").collect()),
            mixing.mix(left, domains, mixing.TARGETS).orderBy("doc_id").toPandas(),
        )
    assert out["all"][0] == out["left"][0]
    assert np.abs(np.stack(out["all"][1].posterior) - np.stack(out["left"][1].posterior)).max() < 1e-6
    assert np.abs(out["all"][1].rate - out["left"][1].rate).max() < 1e-4


def test_mixing_without_labels(docs, labels, rows):
    got = mixing.mix(docs, mixing.domains_of(labels.limit(0)), {"a": 1.0, "b": 1.0}).toPandas()
    assert len(got) == len(rows) and set(got.posterior.map(tuple)) == {(0.5, 0.5)}


def test_copies_of_whole_rates(spark):
    df = spark.createDataFrame([(k, r) for k in range(400) for r in (0.0, 0.5, 0.97, 1.08, 2.3)], "doc_id long, rate double")
    got = df.withColumn("copies", mixing.copies_of(F.col("rate"), F.col("doc_id"))).groupBy("rate").agg(F.avg("copies").alias("m")).collect()
    mean = {r["rate"]: r["m"] for r in got}
    assert mean[0.0] == 0 and mean[0.97] == 1 and mean[1.08] == 1 and 0.4 < mean[0.5] < 0.6 and 2.2 < mean[2.3] < 2.4



def soft_rows(spark, shares, n=1500):
    """tokens and soft posteriors of documents of domains with the given shares."""
    rnd = np.random.default_rng(8)
    kinds = rnd.choice(len(shares), n, p=shares)
    p = np.array([rnd.dirichlet(np.where(np.arange(len(shares)) == k, 40.0, 0.5)) for k in kinds])
    rows = [(k, int(t), [float(x) for x in own]) for k, (t, own) in enumerate(zip(rnd.integers(20, 400, n), p, strict=True))]
    return spark.createDataFrame(rows, "doc_id long, tokens long, posterior array<double>").coalesce(1)


@pytest.mark.parametrize("budget_share", [None, 0.05])
def test_copies_meet_the_targets(spark, monkeypatch, budget_share):
    """The drawn copies, not only the rates, come to the target totals: within four deviations of the draw. Domains far
    above their goals aren't emptied, and a small budget isn't either."""
    rows, names, weights = mixing.stored(soft_rows(spark, [0.75, 0.13, 0.12])), ["good", "poor", "toxic"], np.array([0.97, 0.02, 0.01])
    name = F.col("doc_id").cast("string")
    # The scoring is replaced by the given posteriors; what mix does with them is tested.
    monkeypatch.setattr(mixing, "scorer", lambda *_: lambda d: d.join(scored, "text"))
    docs, scored = rows.select("doc_id", name.alias("text"), F.lit("s").alias("source")), rows.select(name.alias("text"), "tokens", "posterior")
    budget = None if budget_share is None else budget_share * rows.agg(F.sum("tokens")).first()[0]
    got = mixing.mix(docs, docs.limit(0), dict(zip(names, weights, strict=True)), budget).toPandas()
    p, t = np.stack(got.posterior), got.tokens.to_numpy()[:, None]
    want = weights * budget if budget else weights * (p * t).sum(0)[0] / weights[0]
    assert (np.floor(got.rate) <= got.copies).all() and (got.copies <= np.ceil(got.rate)).all()
    chance = (got.rate - np.floor(got.rate)).to_numpy()[:, None]
    deviation = np.sqrt(((p * t) ** 2 * chance * (1 - chance)).sum(0))
    assert (np.abs((p * t * got.copies.to_numpy()[:, None]).sum(0) - want) <= 4 * deviation + 1e-4 * t.sum()).all()
    pure = got[p[:, 2] > 0.9]
    assert pure.rate.sum() == 0 or pure.copies.sum() > 0
    if budget is None:
        kept = mixing.resampled(docs, docs.limit(0), dict(zip(names, weights, strict=True))).groupBy("doc_id").count().collect()
        assert {r["doc_id"]: r["count"] for r in kept} == dict(got[got.copies > 0][["doc_id", "copies"]].to_numpy().tolist())


def test_weights_that_cannot_be_met_are_reported(spark, caplog):
    rows = mixing.stored(soft_rows(spark, [0.98, 0.005, 0.015], 500))
    with caplog.at_level("WARNING", "riskspark.llm.mixing"):
        mixing.fit_rates(rows, [0.5, 0.4, 0.1], names=["good", "poor", "toxic"])
    own = np.array([r.tokens * np.array(r.posterior) for r in rows.collect()]).sum(0)
    goal = np.minimum(np.array([0.5, 0.4, 0.1]) * own[0] / 0.5, own)
    for k, n in enumerate(["good", "poor", "toxic"]):
        assert f"domain {n} gets a weight of {goal[k] / goal.sum():.6f}" in caplog.text
    caplog.clear()
    with caplog.at_level("WARNING", "riskspark.llm.mixing"):
        mixing.fit_rates(rows, [0.99, 0.002, 0.008], names=["good", "poor", "toxic"])
    assert not caplog.records


def test_top_k(spark):
    rnd = np.random.default_rng(4)
    vectors = [(k, [float(x) for x in rnd.normal(size=6).astype(np.float32)]) for k in range(300)]
    vectors += [(300, vectors[0][1]), (301, None), (302, [1.0, None]), (303, [float("nan")] * 6), (304, [0.5]), (None, [1.0] * 6), (5, vectors[5][1])]
    df = spark.createDataFrame(vectors, "vec_id long, vector array<float>").repartition(3)
    sound = {i: np.array([int(np.floor(256 * x)) for x in v] + [0] * (6 - len(v))) for i, v in vectors if i is not None and i not in (301, 302, 303)}
    want = []
    for q in (k for k in sound if k % 50 == 0):
        best = sorted(((-int(sound[q] @ v), i) for i, v in sound.items() if i != q))[:5]
        want += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    for rows_of_shard in (4096, 40):
        search.SHARD_ROWS = rows_of_shard
        got = search.top_k(df, df.where(F.col("vec_id") % 50 == 0), 5).collect()
        assert sorted(map(tuple, got)) == sorted(want)
    search.SHARD_ROWS = 4096


def test_top_k_sql(spark, sf):
    db = duckdb.connect()
    db.execute(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    got = entry.queries()["op2_maxscore"](spark, sf).collect()
    assert sorted(tuple(r) for r in got) == sorted(db.execute(search.OP2_SQL).fetchall())


def test_warc_round_trip(spark, tmp_path):
    big = "é" * 200_000
    pages = [(1, "http://a/x", "<p>1</p>"), (2, "http://a/y", "<p>1</p>"), (3, None, None), (4, "http://b/\r\nz", ""), (5, "u", big), (5, "u", big), (None, "n", "<p>1</p>")]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, payload string").repartition(2)
    folder = f"file://{tmp_path}/w"
    index = warc.write(df, folder)
    got = warc.read(index, folder, payloads=True).toPandas()
    assert len(got) == len(pages)
    cast = lambda x: None if pd.isna(x) else int(x)
    found = {(cast(r.page_id), r.record_type, cast(r.refers_to), r.payload_bytes) for r in got.itertuples()}
    assert found == {(1, "revisit", 2, 8), (2, "response", None, 8), (3, "revisit", 4, 0), (4, "response", None, 0), (5, "response", None, 400_000), (None, "response", None, 8)}
    assert all(r.payload.decode() == big for r in got[got.page_id == 5].itertuples())
    some = warc.read(index.where("page_id = 2"), folder, payloads=True).collect()
    assert [bytes(r["payload"]) for r in some] == [b"<p>1</p>"]


def test_ranges_are_joined():
    rows = [("a", 0, 10), ("a", 10, 5), ("a", 15 + warc.GAP, 5), ("a", 10**9, 1), ("b", 0, 1)]
    assert [(a, s, e, len(i)) for a, s, e, i in warc.ranges(rows)] == [("a", 0, 20 + warc.GAP, 3), ("a", 10**9, 10**9 + 1, 1), ("b", 0, 1, 1)]


def test_url_parts_and_rules(spark):
    cases = [
        ("http://A.Org/x", "a.org", "/x", "org/"), ("https://www.example.org/es/1", "www.example.org", "/es/1", "example.org/es/"),
        ("http://example.org/en/12?q=1", "example.org", "/en/12", "example.org/en/1"), ("http://x.com/fr/#a", "x.com", "/fr/", "com/fr/"),
        ("http://notcom/de/", "notcom", "/de/", None), ("http://y.com?z=/de/", "y.com", "", None), ("http://z.com/de/a", "z.com", "/de/a", "com/de/"),
        ("no scheme", "", "", None), (None, "", "", None), ("http://org", "org", "", None), ("a://b://c/d#e?f", "b:", "//c/d", None), ("x://" + "q" * 5000, "q" * 5000, "", None),
    ]
    df = spark.createDataFrame([(k, c[0]) for k, c in enumerate(cases)], "page_id long, url string")
    got = {r["page_id"]: r for r in urls.ruled(urls.parts_of(df), urls.RULES).collect()}
    for k, (_, host, path, rule) in enumerate(cases):
        assert (got[k]["host"], got[k]["path"], got[k]["rule"]) == (host, path, rule)


def test_url_trees(spark):
    labelled = urls.labelled_urls(spark)
    model = urls.train(labelled)
    held = urls.labelled_urls(spark, 300, seed=77).withColumn("page_id", F.monotonically_increasing_id())
    got = urls.judge(held, model, []).join(held, "page_id").toPandas()
    assert ((got.verdict == "block") == (got.blocked == 1)).mean() > 0.95
    assert urls.judge(held.limit(0), model, urls.RULES).count() == 0


def test_empty_tables(spark, empty, labels, tagger):
    assert near.near_duplicates(empty).count() == 0
    assert quality.classify(empty, labels).count() == 0
    assert quality.classify(empty, labels.limit(0)).count() == 0
    assert winnow.compare_with_edits(empty).count() == 0
    assert packing.pack(empty, public_tokenizers.path("word_bpe_49k.json")).count() == 0
    assert pii.find(empty, tagger).count() == 0 and pii.masked(empty, tagger).count() == 0
    assert mixing.mix(empty, mixing.domains_of(labels), mixing.TARGETS).count() == 0
    assert language.identify(empty, language.learn(empty)).count() == 0
    nothing = spark.createDataFrame([], "vec_id long, vector array<float>")
    assert search.top_k(nothing, nothing, 5).count() == 0


def test_stages_keep_the_columns(spark, docs, labels, tagger, rows):
    kept = quality.filtered(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.select("doc_id").collect()} >= set(range(1, 40)) - {7}
    single = near.deduplicated(docs).toPandas()
    assert list(single.columns) == docs.columns and not single.doc_id.dropna().duplicated().any() and 120 not in set(single.doc_id)
    mixed = mixing.resampled(docs, mixing.domains_of(labels), mixing.TARGETS)
    assert mixed.columns == docs.columns and mixed.dtypes == docs.dtypes
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "personal_data", "mixing", "packing"]


def test_pipeline_runs(spark, sf):
    got = entry.queries()["pipeline"](spark, sf).toPandas()
    assert len(got) and got.groupby("sequence_id").length.sum().max() <= 2048


def test_registered():
    assert {f"op{n}" for n in range(1, 11)} == {n.split("_")[0] for n in catalog.QUERIES if n != "pipeline"}
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(catalog.ORACLES) <= set(entry.oracle_sql())
