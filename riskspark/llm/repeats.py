"""Substring dedup: windows of 20 words that start earlier somewhere else, found behind a count-min prefilter.

Documents are packed once into blocks of compressed text that are stored, and everything after that is messages to and
from blocks; the windows of the whole corpus are never shuffled.

1. Every block adds its windows to a count-min sketch of two rows. The sketch has about eight cells for each window of
   the corpus and is cut into shards, so no part of it grows with the input: a block sends each shard the cells that it
   touches as compressed gaps, a shard merges them and answers with one bit for each, set if the cell was hit twice.
   Counters stop at two, since only "once" and "more often" matter. An estimate is never too low, so no repeated window
   is lost.
2. Only windows whose two cells are both hit twice are grouped, exactly, by 128-bit hashes of their words. A block sends
   each distinct window once, its first in the block, so a passage that a third of all documents share makes one entry
   a block, not one a document. The parts by hash that windows meet in answer with one bit for each: whether it starts
   earlier in another block.
3. Each block removes what its later windows cover.

Exact copies of a whole document are settled before: all but the one with the smallest doc_id lose every word and take
no further part.

Defined cases: words are separated by ASCII white space only and kept as they are. A null or empty text has no words, and
a text of fewer than 20 words no window: nothing is removed. Rows without a doc_id take no part: nothing is removed from
them or because of them. Rows that repeat a doc_id and its words count once and get the same result each; rows that
repeat a doc_id with other words are parts of one document: the earlier start comes first, then the smaller hash of the
text. Other columns, whatever their names, are ignored. An empty table gives an empty table. A document is held whole by
one task, at about 100 bytes a word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.common import stored, table

WINDOW = 20
#: Bytes of text in a block, and of a block that are split into words at once.
BLOCK_BYTES, PIECE_BYTES = 5_000_000, 1_000_000
#: Cells of the sketch for each window of the corpus, its rows, and the cells of a shard as a power of two.
CELLS_PER_WINDOW, ROWS, SHARD_BITS = 8, 2, 24
#: Windows of the corpus for each part in which repeated ones are grouped.
PART_WINDOWS = 1 << 22
WORDS_KEPT = 1 << 18
#: Kinds of messages to a block that don't come from a shard or a part.
OWN, COPIES = -1, -2

_random = np.random.default_rng(20250711)
STEP = [int(x) * 2 + 1 for x in _random.integers(1, 1 << 62, 2, dtype=np.uint64)]
SPACE = re.compile(rb"[\x20\x09-\x0D]")
BLOCKS = "block long, doc_id array<long>, n_words array<int>, words array<binary>, payload binary"
MESSAGE = {"block": pa.int64(), "kind": pa.int64(), "data": pa.binary()}
FOUND = {"part": pa.int64(), "block": pa.int64(), "data": pa.binary()}


class WordHashes(dict):
    """Numbers of words, with a table of their 128-bit hashes. Forgets all when it gets large."""

    def __init__(self):
        self.digests = bytearray()

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.digests += xxhash.xxh3_128_digest(word)
        return number

    def of(self, words: list[bytes]) -> np.ndarray:
        """Two 64-bit hashes of each word, as two rows."""
        if len(self) > WORDS_KEPT:
            self.clear()
            self.digests = bytearray()
        numbers = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        both = np.frombuffer(bytes(self.digests), np.uint64).reshape(-1, 2)
        return np.stack((both[:, 0].take(numbers), both[:, 1].take(numbers)))


def pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words of a text, a bounded part of it at a time."""
    start = 0
    while start < len(text):
        cut = SPACE.search(text, start + size) if len(text) - start > size else None
        end = cut.start() if cut else len(text)
        yield text[start:end].split()
        start = end


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def windows(payload: bytes, n_words: list[int], hashes: WordHashes) -> np.ndarray:
    """Two hashes of each window of a block's documents, in order, as two rows; together they name its words."""
    parts = [hashes.of(words) for words in pieces(payload)]
    own = np.concatenate(parts, 1) if parts else np.zeros((2, 0), np.uint64)
    n = own.shape[1] - WINDOW + 1
    if n <= 0:
        return np.zeros((2, 0), np.uint64)
    counts = np.array(n_words, np.int64)
    inside = np.repeat(np.cumsum(counts), counts)[:n] - np.arange(n) >= WINDOW
    out = np.empty((2, int(inside.sum())), np.uint64)
    for side in range(2):
        step = lambda k: np.uint64(pow(STEP[side], k, 1 << 64))
        run = {1: own[side]}
        for size in (2, 4, 8, 16):
            half = run[size // 2]
            run[size] = half[: len(half) - size // 2] * step(size // 2) + half[size // 2 :]
        whole = run[16][:n] * step(WINDOW - 16) + run[4][16 : 16 + n]
        out[side] = mixed(whole[inside])
    return out


def starts_of(n_words: list[int]) -> np.ndarray:
    """The number of the first window of each document of a block, and of all windows."""
    return np.concatenate(([0], np.cumsum(np.maximum(np.array(n_words, np.int64) - WINDOW + 1, 0))))


def in_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """BLOCKS: the texts of docs (doc_id, text) in compressed blocks, with what is said of each document: its number of words
    and a hash of them. Names of blocks are final only in a stored table."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, rows, size = TaskContext.get().partitionId() << 32, [], 0

        def block() -> pa.RecordBatch:
            ids, texts, counts, digests = zip(*rows, strict=True)
            payload = packed(b"\n".join(texts), level=6)
            kinds = pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.binary()), pa.binary()
            arrays = [pa.array(c, t) for c, t in zip(([name], [ids], [counts], [digests], [payload]), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["block", "doc_id", "n_words", "words", "payload"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py() or b""
                digest, count = xxhash.xxh3_128(), 0
                for words in pieces(text):
                    count += len(words)
                    digest.update(b" ".join(words) + b" ")
                rows.append((doc_id.as_py(), text, count, digest.digest()))
                size += len(text)
                if size >= block_bytes:
                    yield block()
                    name, rows, size = name + 1, [], 0
        if rows:
            yield block()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(pack, BLOCKS)


def packed(data: bytes, level: int = 1) -> bytes:
    """Compressed, with its length before it."""
    return len(data).to_bytes(8, "little") + (pa.Codec("zstd", compression_level=level).compress(data, asbytes=True) if data else b"")


def opened(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], size, codec="zstd", asbytes=True) if size else b""


def planes(*columns: np.ndarray) -> bytes:
    """Columns of integers, equally long: differences, lowest bytes first, compressed."""
    out = [len(columns[0]).to_bytes(8, "little")]
    for c in columns:
        steps = np.diff(c, prepend=c.dtype.type(0))
        out.append(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, c.dtype.itemsize).T).tobytes())
    return packed(b"".join(out))


def from_planes(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw, out, at = opened(data), [], 8
    n = int.from_bytes(raw[:8], "little")
    for kind in map(np.dtype, kinds):
        size = kind.itemsize * n
        steps = np.frombuffer(raw[at : at + size], np.uint8).reshape(kind.itemsize, n).T
        out.append(np.cumsum(np.ascontiguousarray(steps).view(kind).ravel(), dtype=kind))
        at += size
    return out


def cells(names: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The cell of each window in a row of a sketch of 2**bits cells."""
    return mixed(names[row] ^ (names[1 - row] >> np.uint64(7 + row))) >> np.uint64(64 - bits)


def by_shard(own: np.ndarray, shard_bits: int) -> Iterator[tuple[int, int, int]]:
    """(shard, first, end) of the ascending cells ``own``."""
    shard = own >> np.uint64(shard_bits)
    cuts = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1], [True]))) if len(own) else []
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(shard[low]), int(low), int(high)


def table_of(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    return pa.table({c: pa.array(x, t) for x, (c, t) in zip(columns, kinds.items(), strict=True)})


def hit_twice(blocks: DataFrame, bits: int, shard_bits: int) -> DataFrame:
    """block, kind (a shard), data: for each cell that a block touches in a shard, in order, one bit: whether it was hit
    more than once by all blocks together."""
    shards = 1 << (bits - shard_bits)
    kinds = {"shard": pa.int64(), "block": pa.int64(), "cells": pa.binary(), "more": pa.binary()}

    def touch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, n_words, payload in zip(*(batch.column(k) for k in range(3)), strict=True):
                names, out = windows(opened(payload.as_py()), n_words.as_py(), WordHashes()), []
                for row in range(ROWS):
                    every = np.sort(cells(names, row, bits))
                    head = np.concatenate(([True], every[1:] != every[:-1])) if len(every) else np.zeros(0, bool)
                    own, several = every[head], np.diff(np.append(np.flatnonzero(head), len(every))) > 1
                    for shard, low, high in by_shard(own, shard_bits):
                        inside = (own[low:high] & np.uint64((1 << shard_bits) - 1)).astype(np.uint32)
                        more = np.packbits(several[low:high]).tobytes() if several[low:high].any() else None
                        out.append((row * shards + shard, name.as_py(), planes(inside), more))
                yield from table_of(out, kinds).to_batches()

    def merge(rows: pa.Table) -> pa.Table:
        hits, out = np.zeros(1 << shard_bits, np.uint8), []
        for data, more in zip(rows.column("cells").to_pylist(), rows.column("more").to_pylist(), strict=True):
            (own,) = from_planes(data, "u4")
            hits[own] = np.minimum(hits[own] + np.uint8(1), 2)
            if more:
                hits[own[np.unpackbits(np.frombuffer(more, np.uint8), count=len(own)).astype(bool)]] = 2
        for block, kind, data in zip(*(rows.column(c).to_pylist() for c in ("block", "shard", "cells")), strict=True):
            (own,) = from_planes(data, "u4")
            out.append((block, kind, np.packbits(hits[own] > 1).tobytes()))
        return table_of(out, MESSAGE)

    touched = blocks.select("block", "n_words", "payload").mapInArrow(touch, "shard long, block long, cells binary, more binary")
    return touched.groupBy("shard").applyInArrow(merge, "block long, kind long, data binary")


def estimated(names: np.ndarray, answers: dict[int, bytes], bits: int, shard_bits: int) -> np.ndarray:
    """Which windows of a block the sketch takes for repeated."""
    shards, n = 1 << (bits - shard_bits), names.shape[1]
    low_bits = np.uint64(max(1, n).bit_length())
    maybe = np.ones(n, bool)
    for row in range(ROWS):
        # One sort of (cell, number of the window).
        keys = np.sort((cells(names, row, bits) << low_bits) | np.arange(n, dtype=np.uint64))
        cell, number = keys >> low_bits, (keys & ((np.uint64(1) << low_bits) - np.uint64(1))).astype(np.int64)
        head = np.concatenate(([True], cell[1:] != cell[:-1])) if n else np.zeros(0, bool)
        own = cell[head]
        twice = np.zeros(len(own), bool)
        for shard, low, high in by_shard(own, shard_bits):
            twice[low:high] = np.unpackbits(np.frombuffer(answers[row * shards + shard], np.uint8), count=high - low).astype(bool)
        maybe[number] &= twice[np.cumsum(head) - 1]
    return maybe


def candidates(blocks: DataFrame, messages: DataFrame, bits: int, shard_bits: int, parts: int) -> DataFrame:
    """part, block, data: the windows that the sketch takes for repeated, each distinct one once from each block, by the part
    of the hashes that it belongs to; and for each block under a negative part what it has to remember of them.
    ``messages`` (block, kind, data) are the answers of the shards and the copies."""

    def probe(block: pa.Table, said: pa.Table) -> pa.Table:
        if not block.num_rows:
            return table_of([], FOUND)
        (row,) = block.to_pylist()
        answers = dict(zip(said.column("kind").to_pylist(), said.column("data").to_pylist(), strict=True))
        names = windows(opened(row["payload"]), row["n_words"], WordHashes())
        maybe, first = estimated(names, answers, bits, shard_bits), starts_of(row["n_words"])
        for k in [k for k, i in enumerate(row["doc_id"]) if i is None] + np.frombuffer(answers.get(COPIES) or b"", np.int32).tolist():
            maybe[first[k] : first[k + 1]] = False
        at = np.flatnonzero(maybe)
        doc = np.searchsorted(first, at, "right") - 1
        ids = np.array([0 if i is None else i for i in row["doc_id"]], np.int64)[doc]
        tie = np.array([int.from_bytes(w[:4], "little") for w in row["words"]], np.uint32)[doc]
        start, a, b = (at - first[doc]).astype(np.int32), names[0][at], names[1][at]
        order = np.lexsort((tie, start, ids, b, a))
        as_early = first_places(order, a, b, ids, start, tie)
        # Rows that repeat a document are at the same place, and so as early as each other.
        sent = np.sort(order[as_early])
        part = (a[sent] >> np.uint64(32)).astype(np.int64) % parts
        remembered = np.zeros(len(at), np.int64)
        remembered[sent] = part + 1
        out = [(-1 - row["block"], row["block"], planes(at.astype(np.int64), remembered))]
        for p in np.unique(part).tolist():
            some = sent[part == p]
            hashes = a[some].tobytes() + b[some].tobytes()
            places = planes(ids[some], start[some], tie[some])
            out.append((p, row["block"], len(hashes).to_bytes(8, "little") + hashes + places))
        return table_of(out, FOUND)

    left = blocks.select("block", "doc_id", "n_words", "words", "payload")
    return left.groupBy("block").cogroup(messages.groupBy("block")).applyInArrow(probe, "part long, block long, data binary")


def first_places(order: np.ndarray, a, b, ids, start, tie) -> np.ndarray:
    """Of windows in an order by hash and place: which are as early as the first of the same words."""
    if not len(order):
        return np.zeros(0, bool)
    a, b, ids, start, tie = (x[order] for x in (a, b, ids, start, tie))
    head = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    of = np.flatnonzero(head)[np.cumsum(head) - 1]
    return (ids == ids[of]) & (start == start[of]) & (tie == tie[of])


def settled(found: DataFrame) -> DataFrame:
    """block, kind, data: for each window that a block sent to a part, in order, one bit: whether another block has it
    earlier; and what blocks remember, as it is."""

    def settle(rows: pa.Table) -> pa.Table:
        blocks, data = rows.column("block").to_pylist(), rows.column("data").to_pylist()
        part = rows.column("part")[0].as_py()
        if part < 0:
            return table_of([(blocks[0], OWN, data[0])], MESSAGE)
        columns, sizes = [], []
        for d in data:
            size = int.from_bytes(d[:8], "little")
            a, b = np.frombuffer(d[8 : 8 + size], np.uint64).reshape(2, -1)
            columns.append((a, b, *from_planes(d[8 + size :], "i8", "i4", "u4")))
            sizes.append(len(a))
        a, b, ids, start, tie = (np.concatenate(c) for c in zip(*columns, strict=True))
        order = np.lexsort((tie, start, ids, b, a))
        later = np.ones(len(order), bool)
        later[order] = ~first_places(order, a, b, ids, start, tie)
        ends = np.cumsum([0, *sizes])
        return table_of([(block, part, np.packbits(later[low:high]).tobytes()) for block, low, high in zip(blocks, ends[:-1], ends[1:], strict=True)], MESSAGE)

    return found.groupBy("part").applyInArrow(settle, "block long, kind long, data binary")


def later_windows(blocks: DataFrame, cells_per_window: float = CELLS_PER_WINDOW, shard_bits: int = SHARD_BITS, part_windows: int = PART_WINDOWS) -> DataFrame:
    """block, kind, data: all messages from which a block knows what to remove."""
    said = blocks.select("block", F.posexplode(F.arrays_zip("doc_id", "n_words", "words")).alias("k", "d")).select("block", "k", "d.*")
    said = said.where(f"doc_id is not null and n_words >= {WINDOW}")
    n_windows = said.agg(F.sum(F.col("n_words") - (WINDOW - 1))).first()[0] or 0
    first = said.groupBy("words").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first <> last")
    copies = said.join(first, "words").where("doc_id > first").groupBy("block").agg(F.sort_array(F.collect_list("k")).alias("ks"))
    copies = stored(copies.mapInArrow(pack_places, "block long, kind long, data binary"))
    bits = max(shard_bits, round(np.log2(max(1, cells_per_window * n_windows))))
    answers = hit_twice(blocks, bits, shard_bits).union(copies)
    found = candidates(blocks, answers, bits, shard_bits, max(1, n_windows // part_windows))
    return settled(found).union(copies)


def pack_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(block.as_py(), COPIES, np.array(ks.as_py(), np.int32).tobytes()) for block, ks in zip(batch.column(0), batch.column(1), strict=True)]
        yield from table_of(rows, MESSAGE).to_batches()


def removed(n_words: list[int], answers: dict[int, bytes]) -> np.ndarray:
    """Which words of a block go."""
    ends, first = np.cumsum([0, *n_words]), starts_of(n_words)
    steps = np.zeros(ends[-1] + 1, np.int64)
    if OWN in answers:
        at, remembered = from_planes(answers[OWN], "i8", "i8")
        gone = remembered == 0  # later in this very block
        for p in np.unique(remembered[~gone]).tolist():
            mine = np.flatnonzero(remembered == p)
            gone[mine] = np.unpackbits(np.frombuffer(answers[p - 1], np.uint8), count=len(mine)).astype(bool)
        at = at[gone]
        doc = np.searchsorted(first, at, "right") - 1
        word = ends[doc] + at - first[doc]
        steps[word] += 1
        np.subtract.at(steps, word + WINDOW, 1)
    for k in np.frombuffer(answers.get(COPIES) or b"", np.int32).tolist():
        steps[ends[k]] += 1
        steps[ends[k + 1]] -= 1
    return np.cumsum(steps[:-1]) > 0


def left_over(blocks: DataFrame, later: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and kept, the text) of every document of the blocks."""
    kinds = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string()} | ({"kept": pa.string()} if with_text else {})

    def cut(block: pa.Table, said: pa.Table) -> pa.Table:
        out: list[tuple] = []
        for row in block.to_pylist():
            gone = removed(row["n_words"], dict(zip(said.column("kind").to_pylist(), said.column("data").to_pylist(), strict=True)))
            ends = np.cumsum([0, *row["n_words"]])
            lost = np.diff(np.concatenate(([0], np.cumsum(gone)))[ends])
            texts = kept_texts(pieces(opened(row["payload"])), ends.tolist(), gone, with_text)
            out += [(i, n, g, *t) for i, n, g, t in zip(row["doc_id"], row["n_words"], lost.tolist(), texts, strict=True)]
        return table_of(out, kinds)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text
    left = blocks.select("block", "doc_id", "n_words", "payload")
    return left.groupBy("block").cogroup(later.groupBy("block")).applyInArrow(cut, schema)


def kept_texts(parts: Iterator[list[bytes]], ends: list[int], gone: np.ndarray, with_text: bool) -> Iterator[tuple]:
    """The digest, and on request the text, of what is left of each document of a block."""
    words, low, keep = [], 0, (~gone).tolist()
    for first, end in zip(ends[:-1], ends[1:], strict=True):
        digest, texts, at, some = sha256(), [], first, False
        while at < end:
            if at >= low + len(words):
                low, words = low + len(words), next(parts)
            upto = min(end, low + len(words))
            kept = b" ".join(compress(words[at - low : upto - low], keep[at:upto]))
            if kept:
                kept, some = (b" " if some else b"") + kept, True
                digest.update(kept)
                if with_text:
                    texts.append(kept)
            at = upto
        yield (digest.hexdigest(), b"".join(texts).decode()) if with_text else (digest.hexdigest(),)


def without_repeats(docs: DataFrame, with_text: bool = False, block_bytes: int = BLOCK_BYTES, **sketch) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, and on request the kept text, of each row of docs (doc_id, text)."""
    blocks = stored(in_blocks(docs, block_bytes))
    return left_over(blocks, later_windows(blocks, **sketch), with_text)


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of windows that start earlier somewhere."""
    return without_repeats(table(spark, sf_dir, "documents"))
