"""Large components, long texts and lines, spelled-out addresses, clashing column names."""

import random

import numpy as np
import pytest

from riskspark.llm import crf, language, near, packing, pii, quality, search


def best(vectors, queries, k):
    out = []
    for q in queries:
        a = [int(np.floor(256 * x)) for x in vectors[q]]
        scores = []
        for i, v in vectors.items():
            if i != q:
                scores.append((-sum(x * int(np.floor(256 * y)) for x, y in zip(a, v, strict=True)), i))
        out += [(q, rank, i, max(-(2**63), min(2**63 - 1, -s))) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("size", [1.0, 40_000.0, 3e6])
def test_search_is_exact_for_large_components(spark, size):
    rng = np.random.default_rng(3)
    vectors = {k: (size * rng.standard_normal(64)).tolist() for k in range(60)}
    vectors |= {100: vectors[3], 101: [size] * 64, 102: [-size] * 64}
    df = spark.createDataFrame([(k, v) for k, v in vectors.items()], "vec_id long, vector array<double>")
    queries = [0, 3, 50, 101, 102]
    got = search.top_k(df, df.where(df.vec_id.isin(queries)), 5).collect()
    assert sorted(map(tuple, got)) == best(vectors, queries, 5)


def test_search_of_empty_tables_and_extra_columns(spark):
    schema = "vec_id long, vector array<double>, score double, shard int"
    some, none = spark.createDataFrame([(1, [1.0], 0.5, 3), (2, [2.0], 0.5, 3)], schema), spark.createDataFrame([], schema)
    assert search.top_k(some, none, 5).count() == 0 and search.top_k(none, some, 5).count() == 0
    assert sorted(map(tuple, search.top_k(some, some, 5).collect())) == [(1, 1, 2, 131072), (2, 1, 1, 131072)]


def test_a_language_of_long_texts_only_is_learned(spark):
    rnd = random.Random(1)
    english, german = "the and of to in that is was for with".split(), "der die und ein nicht mit sich auf von zu".split()
    said = lambda words, n: " ".join(rnd.choice(words) for _ in range(n))
    rows = [(k, said(english, 40), "en") for k in range(40)] + [(100 + k, said(german, 9000), "de") for k in range(10)]
    rows += [(200 + k, said(german, 30), None) for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    models = language.learn(docs)
    assert set(models) == {"en", "de"}
    found = {r.doc_id: r.lang_pred for r in language.identify(docs, models).collect()}
    assert all(found[k] == ("en" if k < 100 else "de") for k in found)


def test_the_sample_is_the_first_by_hash(spark):
    docs = spark.createDataFrame([(k, f"text number {k}", "ab"[k % 2]) for k in range(300)], "doc_id long, text string, lang string")
    once, again = (language.learn(d, sample=7) for d in (docs, docs.repartition(5)))
    for lang in "ab":
        assert all(np.array_equal(x.grams, y.grams) for x, y in zip(once[lang], again[lang], strict=True))


@pytest.fixture(scope="module")
def model():
    return crf.train(pii.labelled_table())


@pytest.mark.parametrize("text", ["jane [at] example.org", "write to jane (at) example.org please", "jane at example.org", "jane at example dot org", "jane [at] example [dot] org"])
def test_spelled_out_addresses_are_decoded(model, text):
    assert list(pii.telling_lines(text)) == [(0, len(text))]
    added = pii.Finder(model).added([text], [pii.base_spans(text)])[0]
    (span,) = added["email"]
    assert text[slice(*span)].startswith("jane") and text[slice(*span)].endswith("org")


def test_whatever_a_span_may_hold_is_telling():
    for at in (" at ", "@", " [at] ", "(at)", " {AT} "):
        for dot in (".", " dot ", "[dot]", " (DOT) "):
            found = f"jane{at}example{dot}org"
            assert pii.holds("email", found) and pii.TELLING.search(found)


def test_long_lines_have_the_tags_of_short_ones(model, monkeypatch):
    rows = pii.labelled_table(40, seed=11)
    text = " ".join(rows["word"])
    want = pii.Finder(model).added([text], [pii.base_spans(text)])
    monkeypatch.setattr(pii, "LONG_LINE", 10)
    assert pii.Finder(model).added([text], [pii.base_spans(text)]) == want
    words = np.array([crf.describe(w) for w in rows["word"]])
    whole = crf.decode(model, words, np.array([len(words)]))
    for size in (1, 2, 7, 1000):
        assert np.array_equal(crf.decode_long(model, [words[k : k + size] for k in range(0, len(words), size)]), whole)
    assert len(crf.decode_long(model, [])) == 0


def test_clashing_columns_pass_the_filters(spark):
    rnd = random.Random(2)
    rows = [(k, " ".join(rnd.choice("the of and to in a is that".split()) + str(rnd.randrange(9)) for _ in range(60)), "en", 1, 2, 3) for k in range(30)]
    rows += [(40, rows[0][1], "en", 1, 2, 3), (None, "no name", "en", 1, 2, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept_id int, gone_id int, several_id int")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(30)], "doc_id long, quality int, toxic int")
    left = near.deduplicated(docs)
    assert left.columns == docs.columns and sorted(-1 if r.doc_id is None else r.doc_id for r in left.collect()) == [-1, *range(30)]
    kept = quality.filtered(docs, labels)
    assert kept.columns == docs.columns and kept.count() >= 25


def test_packing_searches_on_after_a_full_set_of_neighbours():
    # Two hundred short documents of either word, in turn: those that share the seed's word come before any other.
    documents = [np.array([5 + 2 * (k % 2)] * 9 + [packing.END]) for k in range(400)]
    pieces = packing.pack_shard(documents, packing.Corpus(np.ones(8), 10.0))
    first = [d for d, _, _, sequence, _ in pieces if sequence == 0]
    assert len(first) > 200 > 2 * packing.NEIGHBOURS and all(d % 2 == 0 for d in first[:200])
    assert sorted((d, n) for d, _, n, _, _ in pieces if n == 10)[-1][0] == 399 and sum(n for _, _, n, _, _ in pieces) == 4000


def test_new_words_are_encoded_together():
    """The ids are those of every word by itself, and calls of the tokenizer don't grow with the words."""
    import public_tokenizers

    from riskspark.llm import packing

    class Counting:
        def __init__(self, inner):
            self.inner, self.calls = inner, 0

        def encode(self, *args, **kwargs):
            self.calls += 1
            return self.inner.encode(*args, **kwargs)

    words = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    plain = words.tokenizer
    words.tokenizer = counted = Counting(plain)
    odd = "é ́x <|endoftext|>a ﬁ Å İ 's d 't\x0b'S ​ x\x1fy ﻿ 漢字"
    texts = [odd, "", "  ", " ".join(f"w{k}ord" for k in range(3000)), odd]
    got = words.encode([t.encode() for t in texts])
    want = [[i for w in t.encode().split() for i in plain.encode(w.decode(), add_special_tokens=False).ids] + [packing.END] for t in texts]
    assert [x.tolist() for x in got] == want
    assert counted.calls <= 4


def test_new_words_are_encoded_in_small_calls():
    """Long calls cost more a word, and the token that tells most is that of a full sort."""
    import numpy as np
    import public_tokenizers

    from riskspark.llm import packing

    words = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    calls, tokenizer = [], words.tokenizer

    class Recorded:
        def encode(self, text, **options):
            calls.append(len(text.split()))
            return tokenizer.encode(text, **options)

    words.tokenizer = Recorded()
    texts = [" ".join(f"word{i * k}x it's" for i in range(k * 200)).encode() for k in range(4)]
    got = words.encode(texts)
    assert max(calls) <= 128 and sum(calls) == len(words)
    for text, ids in zip(texts, got):
        assert ids.tolist() == [*tokenizer.encode(text.decode(), add_special_tokens=False).ids, packing.END]
    doc, term, count = packing.term_counts(got)
    for k, told in enumerate(packing.telling_token(got).tolist()):
        mine = [(c * np.log2(t + 2), t) for d, t, c in zip(doc, term, count) if d == k]
        assert told == (max(mine)[1] if mine else 0)


def test_pieces_are_encoded_once_for_all_words_that_hold_them():
    """Words that differ in case and signs share their pieces, contractions and all, and the ids stay those of the text."""
    import random

    import public_tokenizers

    from riskspark.llm import packing

    words = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["".join(f"{w}{k % 10}{sign} " for k in range(300) for w in ("Word", "word") for sign in (",", ".", "!!", "'s"))]
    rnd = random.Random(5)
    signs = ["a", "É", "œ", "'s", "'", "'L", "l", "ve", "'d", "''", "’", "½", "ª", "€", " ", "\t", " ", "\x85", "\x1c", "7", "#", "…", "\0"]
    texts += ["".join(rnd.choice(signs) for _ in range(rnd.randrange(60))) for _ in range(400)]
    texts[7:9] = ["x <|endoftext|>'s", "İ ́a 漢字𝒳 's'"]
    for text, ids in zip(texts, words.encode([t.encode() for t in texts]), strict=True):
        assert ids.tolist() == [*words.tokenizer.encode(text, add_special_tokens=False).ids, packing.END]
    again = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    again.encode([texts[0].encode()])
    assert len(again) == 1 + 10 + 4


def test_a_worker_keeps_the_pieces_of_earlier_tasks():
    import public_tokenizers

    from riskspark.llm import packing

    path = public_tokenizers.path("word_bpe_49k.json")
    packing.word_ids(path).encode([b"kept for later"])
    assert {"kept".encode("utf-16-le"), "later".encode("utf-16-le")} <= set(packing.word_ids(path))
