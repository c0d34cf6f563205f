"""Lexical retrieval packing: documents that share rare tokens fill a window together.

Texts become token ids, with an end id after each. Documents are dealt by range of their most telling token into shards
of bounded size, each with an inverted index of its own; document frequencies and the mean length, which its BM25
weights use, are those of the whole corpus (a table of at most one row per vocabulary entry). In a shard, every document
in turn becomes a seed, and its best unused neighbours fill the seed's window. The last one that goes in is cut where
the window ends, and its rest stays unused. So only the last window of a shard is not full, and that is cut into windows
whose lengths are powers of two.

Defined cases: a null text is empty and consists of the end id; documents longer than a window fill windows of their own
and leave a rest; rows that repeat a doc_id are packed one by one.
"""

from __future__ import annotations

import json
import os
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskspark.llm.common import spread, stored, table
from riskspark.llm.grams import groups

WINDOW = 2048
END = 1
SHARD_DOCS, SHARD_TOKENS = 4096, 16_000_000
K1, B = 1.2, 0.75
QUERY_TERMS, NEIGHBOURS = 24, 64
#: Windows shorter than this are padded.
SHORTEST = 64
WORDS_KEPT = 1 << 20
WORDS_TOGETHER = 64

#: What splits texts in the tokenizer's file; a piece is what this pattern finds.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPACE, LETTER, DIGIT, OTHER, STRANGE = range(5)


def char_tables() -> tuple[np.ndarray, np.ndarray]:
    """The kind and the lower case of each UTF-16 unit. Latin letters up to U+017F and common punctuation are known: no normal
    form changes them, and lower case is one of them too. All others are STRANGE."""
    kind, lower = np.full(1 << 16, STRANGE, np.uint8), np.arange(1 << 16, dtype=np.uint16)
    known = [chr(c) for c in [*range(0x180), *range(0x2010, 0x2028), 0x20AC] if c != 0x130]
    for c in known:
        kind[ord(c)] = {"L": LETTER, "N": DIGIT}.get(unicodedata.category(c)[0], OTHER)
        lower[ord(c)] = ord(c.lower())
    kind[[*range(9, 14), 0x20, 0x85, 0xA0]] = SPACE
    return kind, lower


KIND, LOWER = char_tables()


def last_tokens(path: str) -> np.ndarray | None:
    """Whether each id ends a piece, if the tokenizer of the file lower-cases and splits texts by ``SPLIT``."""
    with open(path, encoding="utf-8") as file:
        settings = json.load(file)
    normal = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
    split = {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True}
    as_bytes = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
    wanted = {
        "normalizer": {"type": "Sequence", "normalizers": normal}, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [split, as_bytes]},
        "post_processor": None, "truncation": None, "padding": None,
    }
    model = settings["model"]
    if any(settings.get(k) != v for k, v in wanted.items()) or model["type"] != "BPE" or model.get("end_of_word_suffix") != "</w>" or model.get("dropout"):
        return None
    last = np.zeros(max([*model["vocab"].values(), *(t["id"] for t in settings["added_tokens"])]) + 1, bool)
    last[[k for token, k in model["vocab"].items() if token.endswith("</w>")]] = True
    return last


def piece_starts(units: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Where pieces of lower-case UTF-16 units start. Runs of a kind are pieces, digits are pieces each, and a run that
    begins with an apostrophe may be a contraction."""
    start = np.ones(len(units), bool)
    start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    start &= kind != SPACE
    at = np.flatnonzero(start & (units == ord("'")))
    one, two = (np.append(units[at[at + k < len(units)] + k], np.zeros(np.count_nonzero(at + k >= len(units)), np.uint16)) for k in (1, 2))
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    start[at[short | long] + 1] = False
    ends = np.concatenate((at[short] + 2, at[long] + 3))
    ends = ends[ends < len(units)]
    start[ends] = kind[ends] != SPACE
    return start


class WordIds(dict):
    """Token ids of words and pieces, encoded once. A tokenizer that drops white space treats the words between it
    independently, and one that splits texts by ``SPLIT`` its pieces, of which there are fewer.

    Maps a piece (bytes, UTF-16) or a word (str) to its place in ``starts``, ``lengths`` and ``ids``. Place 0 is the end of a document."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.last = last_tokens(path)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.new: list[bytes | str] = []
        # Machine integers: a list of numbers takes five times the memory and is slow to turn into an array.
        self.starts, self.lengths, self.ids = array("q", [0]), array("q", [1]), array("I", [END])

    def __missing__(self, word: bytes | str) -> int:
        self.new.append(word)
        self[word] = place = len(self) + 1
        return place

    def learn(self) -> None:
        """Encodes new words or pieces, some at once with a blank between them: calls for single words cost more than the
        words, and in calls for a thousand a word costs nearly twice as much as in those for a hundred."""
        for k in range(0, len(self.new), WORDS_TOGETHER):
            words = self.new[k : k + WORDS_TOGETHER]
            pieces = isinstance(words[0], bytes)
            text = b" \0".join(words).decode("utf-16-le") if pieces else " ".join(words)
            found = self.tokenizer.encode(text, add_special_tokens=False)
            ids = np.array(found.ids, np.uint32)
            if pieces:
                sizes = np.diff(np.flatnonzero(self.last[ids]), prepend=-1)
            else:
                ends = np.cumsum([len(w) + 1 for w in words])
                at = np.fromiter((start for start, _ in found.offsets), np.int64, len(found))
                sizes = np.bincount(np.searchsorted(ends, at, "right"), minlength=len(words))
            if len(sizes) != len(words) or sizes.sum() != len(ids):
                raise ValueError(f"the tokenizer splits {len(words)} words into {len(sizes)}")
            self.starts.frombytes((len(self.ids) + np.cumsum(sizes) - sizes).astype(np.int64).tobytes())
            self.lengths.frombytes(sizes.astype(np.int64).tobytes())
            self.ids.frombytes(ids.tobytes())
        self.new = []

    def pieces(self, texts: list[bytes]) -> list[np.ndarray | None]:
        """The places of each text's pieces; None for texts with strange characters or added tokens, and all texts if the
        tokenizer splits in another way."""
        if self.last is None or not texts:
            return [None] * len(texts)
        raw = [t.decode().encode("utf-16-le") for t in texts]
        units = np.frombuffer(b" \0".join([*raw, b""]), np.uint16)
        ends = np.cumsum([len(r) // 2 + 1 for r in raw])
        begins = np.concatenate(([0], ends[:-1]))
        kind = KIND[units]
        strange = np.searchsorted(ends, np.flatnonzero(kind == STRANGE), "right")
        odd = {*np.unique(strange).tolist(), *(k for k, t in enumerate(texts) if any(a in t for a in self.added))}
        for k in odd:
            kind[begins[k] : ends[k]] = SPACE
        units = LOWER[units]
        start, kept = piece_starts(units, kind), kind != SPACE
        data = units[kept]
        # Without the blanks, each piece ends where the next one starts.
        bounds = np.append(np.flatnonzero(start[kept]), len(data)).astype(np.int32) * 2
        coded = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        own = np.fromiter(map(self.__getitem__, distinct), np.int64, len(distinct))
        places = np.split(own[coded.indices.to_numpy()], np.cumsum(start)[ends - 1][:-1])
        return [None if k in odd else p for k, p in enumerate(places)]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text and the end id."""
        if len(self) > WORDS_KEPT:
            self.forget()
        places: list[np.ndarray] = []
        found = self.pieces(texts)
        self.learn()
        for text, own in zip(texts, found, strict=True):
            words = [w.decode() for w in text.split()] if own is None else []
            places.append(np.fromiter(map(self.__getitem__, words), np.int64, len(words)) if own is None else own)
            places.append(np.zeros(1, np.int64))
        self.learn()
        every = np.concatenate(places) if places else np.zeros(0, np.int64)
        starts, lengths, ids = np.frombuffer(self.starts, np.int64), np.frombuffer(self.lengths, np.int64), np.frombuffer(self.ids, np.uint32)
        size = lengths[every]
        before = np.cumsum(size) - size
        flat = ids[np.repeat(starts[every] - before, size) + np.arange(size.sum())]
        ends = np.cumsum([size_of(lengths, places[2 * k]) + 1 for k in range(len(texts))])
        return np.split(flat, ends[:-1]) if texts else []


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """What a Python worker has encoded stays for its next tasks; ``WORDS_KEPT`` bounds it."""
    return WordIds(path)


def size_of(lengths: np.ndarray, places: np.ndarray) -> int:
    return int(lengths[places].sum())


def term_counts(documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """document, term, count of each distinct term of each document, by document and term. The end isn't a term."""
    doc = np.repeat(np.arange(len(documents), dtype=np.uint64), [len(d) - 1 for d in documents])
    terms = np.concatenate([d[:-1] for d in documents]) if documents else np.zeros(0, np.uint64)
    keys = doc << np.uint64(32) | terms.astype(np.uint64)
    keys.sort()
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(keys)))
    return (keys[first] >> np.uint64(32)).astype(np.int64), (keys[first] & np.uint64(0xFFFFFFFF)).astype(np.int64), count


def telling_token(documents: list[np.ndarray]) -> np.ndarray:
    """The token of each document with the largest count, weighted by the logarithm of its id: later merges are rarer."""
    doc, term, count = term_counts(documents)
    out = np.zeros(len(documents), np.int64)
    if not len(doc):
        return out
    weight = count * np.log2(term + 2)
    first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    best = np.flatnonzero(weight == np.repeat(np.maximum.reduceat(weight, first), np.diff(np.append(first, len(doc)))))
    out[doc[best]] = term[best]  # the last one of a document stays
    return out


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (binary, unsigned 32 bits, little-endian), tokens, key of each row of docs (doc_id, text)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(path)
        narrow = np.uint16 if words.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            for rows in groups(map(len, texts)):
                own = words.encode(texts[rows])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[rows], pa.array([x.astype(narrow).tobytes() for x in own], pa.binary()),
                        pa.array([len(x) for x in own], pa.int64()), pa.array(telling_token(own)), pa.array([np.dtype(narrow).itemsize] * len(own), pa.int32()),
                    ],
                    ["doc_id", "ids", "tokens", "key", "width"],
                )

    schema = "doc_id long, ids binary, tokens long, key long, width int"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(encode, schema)


def ids_of(batch: pa.RecordBatch) -> list[np.ndarray]:
    width = batch.column("width").to_pylist()
    return [np.frombuffer(b, f"<u{w}") for b, w in zip(batch.column("ids").to_pylist(), width, strict=True)]


@dataclass(frozen=True)
class Corpus:
    """Weights of terms, by id, and the mean document length."""

    idf: np.ndarray
    mean_length: float


def corpus_of(rows: DataFrame) -> Corpus:
    """Document frequencies over all rows. One row per vocabulary entry comes back at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            documents = ids_of(batch)
            for at in groups(map(len, documents), 1 << 20):
                df = np.bincount(term_counts(documents[at])[1])
                seen = np.flatnonzero(df)
                yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(df[seen], pa.int64())], ["term", "df"])

    df = rows.select("ids", "width").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toPandas()
    n, total = rows.agg(F.count("*"), F.sum("tokens")).first()
    frequencies = np.zeros(int(df["term"].max()) + 1 if len(df) else 1)
    frequencies[df["term"].to_numpy(int)] = df["df"]
    return Corpus(np.log1p((n - frequencies + 0.5) / (frequencies + 0.5)), (total or 0) / max(n, 1))


class Index:
    """The inverted index of a shard: postings with their BM25 weights, and each document's heaviest terms."""

    def __init__(self, documents: list[np.ndarray], corpus: Corpus):
        doc, term, tf = term_counts(documents)
        length = np.array([len(d) for d in documents])
        weight = corpus.idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[doc] / corpus.mean_length))
        by_weight = np.lexsort((-weight, doc))
        self.first = np.searchsorted(doc, np.arange(len(documents) + 1))
        self.heaviest = term[by_weight]
        by_term = np.argsort(term, kind="stable")
        self.terms, self.at = np.unique(term[by_term], return_index=True)
        self.at = np.append(self.at, len(term))
        self.docs, self.weights, self.size = doc[by_term], weight[by_term], len(documents)

    def neighbours(self, document: int, unused: np.ndarray) -> np.ndarray:
        """The unused documents with the best scores for the heaviest terms of ``document``, best first."""
        low = self.first[document]
        terms = self.heaviest[low : min(low + QUERY_TERMS, self.first[document + 1])]
        if not len(terms):
            return terms
        places = np.searchsorted(self.terms, terms)
        spans = [slice(self.at[p], self.at[p + 1]) for p in places]
        docs = np.concatenate([self.docs[s] for s in spans])
        scores = np.bincount(docs, np.concatenate([self.weights[s] for s in spans]), self.size) * unused
        scores[document] = 0
        k = min(NEIGHBOURS, self.size - 1)
        if k < 1:
            return np.zeros(0, np.int64)
        best = np.argpartition(-scores, k - 1)[:k]
        best = best[scores[best] > 0]
        return best[np.lexsort((best, -scores[best]))]


def pack_shard(documents: list[np.ndarray], corpus: Corpus) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of each piece."""
    pieces: list[tuple[int, int, int, int, int]] = []
    lengths = np.array([len(d) for d in documents])
    sequence = 0
    for document, whole in enumerate(lengths // WINDOW):
        for k in range(whole):
            pieces.append((document, k * WINDOW, WINDOW, sequence, 0))
            sequence += 1
    start, left = lengths // WINDOW * WINDOW, lengths % WINDOW
    index, unused = Index(documents, corpus), left > 0
    seed = 0
    window: list[tuple[int, int, int]] = []
    fill = 0

    def place(document: int) -> None:
        nonlocal fill
        length = int(min(left[document], WINDOW - fill))
        window.append((document, int(start[document]), length))
        start[document] += length
        left[document] -= length
        unused[document] = left[document] > 0
        fill += length

    while True:
        while seed < len(documents) and not unused[seed]:
            seed += 1
        if seed == len(documents):
            break
        last = seed
        place(seed)
        while fill < WINDOW:
            found = index.neighbours(last, unused)
            for document in found:
                place(int(document))
                if fill == WINDOW:
                    break
            # After as many as a search returns, the next search finds those that follow.
            if fill < WINDOW and len(found) < NEIGHBOURS:
                # What is left shares no term with the last document: go on with the next in order.
                rest = np.flatnonzero(unused[seed:])
                if not len(rest):
                    break
                last = seed + int(rest[0])
                place(last)
        if fill < WINDOW:
            break
        pieces += at_offsets(window, sequence)
        sequence, window, fill = sequence + 1, [], 0
    for part in powers_of_two(window, fill):
        pieces += at_offsets(part, sequence)
        sequence += 1
    return pieces


def at_offsets(window: list[tuple[int, int, int]], sequence: int) -> list[tuple[int, int, int, int, int]]:
    out, offset = [], 0
    for document, start, length in window:
        out.append((document, start, length, sequence, offset))
        offset += length
    return out


def powers_of_two(window: list[tuple[int, int, int]], fill: int) -> Iterator[list[tuple[int, int, int]]]:
    """The window cut into parts of falling powers of two; what is shorter than SHORTEST stays together."""
    rest = list(reversed(window))
    while fill:
        size = 1 << (fill.bit_length() - 1)
        size = size if size >= SHORTEST else fill
        part, room = [], size
        while room:
            document, start, length = rest.pop()
            if length > room:
                rest.append((document, start + room, length - room))
                length = room
            part.append((document, start, length))
            room -= length
        fill -= size
        yield part


def pack(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of each piece of docs (doc_id, text)."""
    rows = stored(encoded(docs, path))
    corpus = docs.sparkSession.sparkContext.broadcast(corpus_of(rows))
    parts = spread(docs.sparkSession, rows.count(), 2 * SHARD_DOCS)
    dealt = rows.repartitionByRange(parts, "key", "doc_id").sortWithinPartitions("key", "doc_id", "ids")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[np.ndarray]]]:
        names, own, tokens = [], [], 0
        for batch in batches:
            for name, ids in zip(batch.column("doc_id").to_pylist(), ids_of(batch), strict=True):
                names.append(name)
                own.append(ids)
                tokens += len(ids)
                if len(own) >= SHARD_DOCS or tokens >= SHARD_TOKENS:
                    yield names, own
                    names, own, tokens = [], [], 0
        if own:
            yield names, own

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequences = TaskContext.get().partitionId() << 32
        for names, own in shards(batches):
            pieces = pack_shard(own, corpus.value)
            document, start, length, sequence, offset = (np.array(c, np.int64) for c in zip(*pieces, strict=True))
            crc = [zlib.crc32(own[d][s : s + n].astype("<u4").tobytes()) for d, s, n, _, _ in pieces]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([names[d] for d in document], pa.int64()), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                    pa.array([len(own[d]) for d in document], pa.int64()), pa.array(sequence + sequences), pa.array(offset),
                ],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )
            sequences += int(sequence.max()) + 1

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return dealt.select("doc_id", "ids", "width").mapInArrow(fill, schema)


def op8_pack(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """All documents in windows of 2048 tokens; ``path`` is the tokenizer's file."""
    return pack(table(spark, sf_dir, "documents"), path or public_tokenizers.path("word_bpe_49k.json"))
