"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to three bytes, held as sorted arrays of the grams and contexts that its
sample contains. A byte that a context has seen costs -log2(c / (n + q)) bits, for c of n occurrences and q distinct
bytes; otherwise the escape q / (n + q) is paid and the next shorter context is asked, in which the bytes that the longer
one has seen are excluded. Below the empty context all 256 bytes are equally likely. The statistics are frozen: texts to
be judged don't change them, so code lengths add up over a text's distinct grams.

The trees are trained on a sample of at most ``sample`` documents for each language, and of a longer one on a part of
``sample_chars`` characters that begins at a random place, which bounds what is collected and broadcast.

Defined cases: a text that is null or has no letter gets ``und`` and score 0; so does every text when there is nothing to
learn from. Ties go to the language that comes first by name. Documents with a null doc_id are held out. Rows that
repeat a doc_id are judged one by one. Texts of any length are judged whole. Other columns are ignored. An empty table
gives an empty table.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskspark.llm.common import table
from riskspark.llm.grams import gram_runs, groups

ORDER = 3
UNKNOWN = "und"
SLICE_BITS = 12


@dataclass(frozen=True)
class Level:
    """One context length: code lengths of the grams seen, and the cost of escaping from each context seen."""

    grams: np.ndarray
    bits: np.ndarray
    contexts: np.ndarray
    escapes: np.ndarray


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``wanted`` are in the sorted ``keys``, and whether they are."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def suffix(gram: np.ndarray, order: int) -> np.ndarray:
    """The last ``order`` context bytes of a gram and its byte."""
    return gram & np.uint64((1 << 8 * (order + 1)) - 1)


def code_lengths(levels: list[Level], gram: np.ndarray, order: int) -> np.ndarray:
    """Bits of the last byte of each gram after its first ``order`` bytes."""
    if order < 0:
        return np.full(len(gram), 8.0)
    level = levels[order]
    at, seen = find(level.grams, gram)
    out = np.empty(len(gram))
    out[seen] = level.bits[at[seen]]
    rest = gram[~seen]
    at, known = find(level.contexts, rest >> np.uint64(8))
    shorter = code_lengths(levels, suffix(rest, order - 1) if order else rest, order - 1)
    out[~seen] = shorter + np.where(known, level.escapes[at] if len(level.escapes) else 0, 0)
    return out


def train(texts: list[bytes]) -> list[Level]:
    """The levels of one language, from the empty context up."""
    top, _, counts = gram_runs(texts, ORDER + 1)
    levels: list[Level] = []
    for order in range(ORDER + 1):
        gram, at = np.unique(suffix(top, order), return_inverse=True)
        c = np.bincount(at, counts, len(gram))
        contexts, of = np.unique(gram >> np.uint64(8), return_inverse=True)
        n, q = np.bincount(of, c), np.bincount(of)
        shorter = np.exp2(-code_lengths(levels, suffix(gram, order - 1) if order else gram, order - 1))
        left = np.maximum(1 - np.bincount(of, shorter), 1e-9)
        levels.append(Level(gram, -np.log2(c / (n + q)[of]), contexts, -np.log2(q / (n + q) / left)))
    return levels


def text_bits(models: list[list[Level]], texts: list[bytes]) -> np.ndarray:
    """The code length of each text under each model."""
    gram, doc, n = gram_runs(texts, ORDER + 1)
    kinds, at = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1]))), None
    at = np.repeat(np.arange(len(kinds)), np.diff(np.append(kinds, len(gram))))
    return np.stack([np.bincount(doc, code_lengths(m, gram[kinds], ORDER)[at] * n, len(texts)) for m in models], 1)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def learn(docs: DataFrame, sample: int = 400, sample_chars: int = 20_000) -> dict[str, list[Level]]:
    """Models by language. The sample is the first documents of a language by the hash of their doc_id and text.

    Counts by language and slice of the hash range tell in which slices the first ones lie; only these are ordered.
    """
    chance = F.xxhash64("doc_id", "text")
    allowed = docs.select("doc_id", "lang", "text").where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    allowed = allowed.withColumn("chance", chance).withColumn("slice", F.shiftright("chance", 64 - SLICE_BITS))
    earlier = W.partitionBy("lang").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    counts = allowed.groupBy("lang", "slice").agg(F.count("*").alias("n"))
    first = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).where(F.col("before") < sample).select("lang", "slice")
    place = F.row_number().over(W.partitionBy("lang").orderBy("chance", "doc_id"))
    some = allowed.select("doc_id", "lang", "chance", "slice").join(first, ["lang", "slice"])
    chosen = some.withColumn("place", place).where(F.col("place") <= sample).select("doc_id", "chance").distinct()
    # Ids first: the window doesn't carry texts. The chosen ids are at most ``sample`` for each language.
    rows = allowed.join(F.broadcast(chosen), ["doc_id", "chance"], "left_semi")
    start = F.pmod(F.col("chance"), F.greatest(F.length("text") - sample_chars, F.lit(0)) + 1).cast("int") + 1
    texts: dict[str, list[bytes]] = defaultdict(list)
    for lang, text in sorted({(r["lang"], r["text"]) for r in rows.select("lang", F.col("text").substr(start, F.lit(sample_chars)).alias("text")).collect()}):
        texts[lang].append(text.encode())
    return {lang: train(own) for lang, own in texts.items()}


def identify(docs: DataFrame, models: dict[str, list[Level]]) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits_per_byte of each row of ``docs``. Only the text is looked at."""
    names = sorted(models)
    shared = docs.sparkSession.sparkContext.broadcast([models[k] for k in names])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            data = [(t or "").encode() for t in texts]
            found, scores, rates = [], [], []
            for at in groups(map(len, data)):
                bits = text_bits(shared.value, data[at]) if names else np.zeros((len(data[at]), 0))
                for text, raw, own in zip(texts[at], data[at], bits, strict=True):
                    if not names or not text or not any(map(str.isalpha, text)):
                        found.append(UNKNOWN), scores.append(0.0), rates.append(None)
                        continue
                    best = int(own.argmin())
                    found.append(names[best])
                    scores.append(float(1 / np.exp2(np.maximum(own[best] - own, -1000)).sum()))
                    rates.append(float(own[best] / (len(raw) + 1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(scores, pa.float64()), pa.array(rates, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score", "bits_per_byte"],
            )

    schema = "doc_id long, held_out boolean, lang_pred string, score double, bits_per_byte double"
    return docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(judge, schema)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    return identify(docs, learn(docs))
