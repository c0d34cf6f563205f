"""Spelling variants: words one edit apart, found by joining states with the edge table of a trie.

The words are walked forwards and backwards. If two words differ by one edit, they agree before it and after it, so in
one of the two directions they agree on the first half of the longer one at least. Only nodes from the middle of a word
on are therefore kept, which are narrow; near the root every word would meet every letter.

A node is a prefix, named by a 64-bit hash. Nodes where words part or end are the ones that matter; the path between two
of them is one edge with a label, so a long word takes as many levels as it meets such nodes, not as it has letters. Every
word starts as one state (word, position, node, no edit) for each such node of its own path. The first join spends the
edit: a letter is replaced by the first letter of an edge, or left out, in which case the next letter chooses the edge.
Later joins follow the one edge that the next letter names, level by level, and states whose label does not fit end. A
state that ends where a word ends is a pair, and is confirmed on both words, so hashes that collide cost nothing but a
comparison. Insertions are deletions of the other word, and a letter is only replaced by a larger one; each pair is
mirrored afterwards. States and edges of a node that very many words pass are dealt into parts.

Defined cases: a null text has no words; without a doc_id nothing is deleted from a run. Rows that repeat a doc_id are
rows like any others, and their words are counted. An empty table gives an empty table. Other columns are ignored. Words of any length are treated
alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskspark.llm.common import ascii_lower, stored, table
from riskspark.llm.grams import groups

SHORTEST, LEAST, RATIO = 7, 2, 10
DAMAGED = 31
#: Words that pass a node, above which its states and edges are dealt into parts of about this many.
PART = 50_000
LETTERS_AT_ONCE = 1_000_000

_random = np.random.default_rng(20250712)
STEP, DEPTH, BACKWARDS = (_random.integers(1, 1 << 62, 3, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).tolist()


def word_counts(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, damaged: int = DAMAGED) -> DataFrame:
    """word, n of docs (doc_id, text): maximal runs of letters, A-Z lower-cased, with a letter deleted from those whose
    checksum with the document's id is divisible by ``damaged``; at least ``shortest`` letters and ``least`` occurrences."""
    runs = F.regexp_extract_all("text", F.lit(f"([A-Za-zÀ-ÿ]{{{shortest},}}+)"), F.lit(1))
    found = docs.select("doc_id", F.explode(runs).alias("run")).select("doc_id", ascii_lower(F.col("run")).alias("run"))
    check = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")).cast("binary"))
    cut = F.pmod(F.col("check"), F.length("run")).cast("int")
    shorter = F.concat(F.col("run").substr(F.lit(1), cut), F.col("run").substr(cut + 2, F.length("run")))
    word = F.when(F.col("check") % damaged == 0, shorter).otherwise(F.col("run"))
    words = found.withColumn("check", check).select(word.alias("word")).where(F.length("word") >= shortest)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def names_of_nodes(walks: pa.Array, backwards: np.ndarray) -> pa.ListArray:
    """Hashes of the prefixes of each walk, from half of its length to all of it."""
    lengths = pc.utf8_length(walks).to_numpy(zero_copy_only=False).astype(np.int64)
    letters = np.frombuffer("".join(walks.to_pylist()).encode("utf-32-le"), "<u4").astype(np.uint64)
    starts = np.cumsum(lengths) - lengths
    powers = np.full(int(lengths.max(initial=0)), STEP, np.uint64).cumprod(dtype=np.uint64)
    terms = (letters + np.uint64(1)) * powers[np.arange(len(letters)) - np.repeat(starts, lengths)]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
    counts = lengths - lengths // 2 + 1
    offsets = np.concatenate(([0], np.cumsum(counts)))
    depth = np.arange(offsets[-1]) - np.repeat(offsets[:-1], counts) + np.repeat(lengths // 2, counts)
    at = np.repeat(starts, counts)
    x = sums[at + depth] - sums[at] + depth.astype(np.uint64) * np.uint64(DEPTH) + np.repeat(backwards, counts).astype(np.uint64) * np.uint64(BACKWARDS)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array((x ^ (x >> np.uint64(33))).view(np.int64)))


def paths(words: DataFrame) -> DataFrame:
    """walk, backwards, n, depth, node, letter: the nodes of each word's own path in both directions, from its middle on,
    and the letter that follows (0 at the end)."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in groups(pc.utf8_length(batch.column(0)).to_pylist(), LETTERS_AT_ONCE):
                part = batch.slice(some.start, some.stop - some.start)
                nodes = names_of_nodes(part.column(0), part.column(1).to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([*part.columns, nodes], ["walk", "backwards", "n", "nodes"])

    ways = [F.struct(walk.alias("walk"), F.lit(back).alias("backwards")) for walk, back in ((F.col("word"), False), (F.reverse("word"), True))]
    both = words.select(F.explode(F.array(*ways)).alias("w"), "n")
    named = both.select("w.walk", "w.backwards", "n").mapInArrow(name, "walk string, backwards boolean, n long, nodes array<long>")
    nodes = named.select("walk", "backwards", "n", F.posexplode("nodes").alias("step", "node"))
    nodes = nodes.withColumn("depth", (F.floor(F.length("walk") / 2) + F.col("step")).cast("int"))
    return nodes.select("walk", "backwards", "n", "depth", "node", letter(F.col("walk"), F.col("depth")).alias("letter"))


def letter(walk: Column, at: Column) -> Column:
    """The code point at a place counted from 0; 0 after the end."""
    return F.ascii(walk.substr(at + 1, F.lit(1)))


def part_of(walk: str, parts: str) -> Column:
    return F.pmod(F.xxhash64(walk), F.col(parts)).cast("int")


def trie(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The points where words part or end: each word's own (walk, backwards, n, depth, node, parts), and the edges
    between them (node, part, letter, label, child, child_parts, end, end_n)."""
    path = stored(paths(words))
    passed = path.groupBy("node").agg(F.min("letter").alias("low"), F.max("letter").alias("high"), F.count("*").alias("words"))
    forks = stored(passed.where("low <> high").select("node", F.ceil(F.col("words") / PART).cast("int").alias("parts")))
    own = W.partitionBy("walk", "backwards").orderBy("depth")
    ahead = [F.lead(c).over(own).alias(f"next_{c}") for c in ("depth", "node", "parts")]
    points = stored(path.join(forks, "node").select("walk", "backwards", "n", "depth", "node", "letter", "parts", *ahead))
    last = F.col("next_node").isNull()
    label = F.col("walk").substr(F.col("depth") + 1, F.coalesce("next_depth", F.length("walk")) - F.col("depth"))
    ends = [F.when(last, F.col("walk")).alias("end"), F.when(last, F.col("n")).alias("end_n")]
    child = [F.col("next_node").alias("child"), F.col("next_parts").alias("child_parts")]
    here = points.where("letter = 0").select("node", "parts", "letter", F.lit("").alias("label"), F.lit(None).cast("long").alias("child"),
                                             F.lit(None).cast("int").alias("child_parts"), F.col("walk").alias("end"), F.col("n").alias("end_n"))
    edges = points.where("letter > 0").select("node", "parts", "letter", label.alias("label"), *child, *ends).union(here).distinct()
    dealt = edges.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    return points, stored(dealt)


def near_pairs(words: DataFrame) -> DataFrame:
    """a, b, n_a, n_b: the pairs of words (word, n) that differ by one inserted, deleted or replaced code point, once each."""
    points, edges = trie(words)
    walk, depth = F.col("walk"), F.col("depth")
    start = points.where("letter > 0").select(
        "walk", "backwards", "n", "depth", "node", F.col("letter").alias("own"), letter(walk, depth + 1).alias("following"), part_of("walk", "parts").alias("part")
    )
    replaced = F.when(F.col("letter") > F.col("own"), F.struct(depth.alias("at"), F.lit(1).alias("given")))
    dropped = F.when((F.col("letter") == F.col("following")) & (F.col("following") != F.col("own")), F.struct((depth + 1).alias("at"), F.lit(0).alias("given")))
    fits = (F.col("letter") > F.col("own")) | (F.col("letter") == F.col("following"))
    spent = start.join(edges, ["node", "part"]).where(fits)
    spent = spent.withColumn("way", F.explode(F.array_compact(F.array(replaced, dropped)))).select("*", "way.at", "way.given")
    found, states = [], spent
    while True:
        # A state stands at position ``at`` of its word and has taken an edge of whose label ``given`` letters count as read.
        rest = F.length("label") - F.col("given")
        fits = walk.substr(F.col("at") + F.col("given") + 1, rest) == F.col("label").substr(F.col("given") + 1, rest)
        arrived = states.where(fits).withColumn("at", F.col("at") + F.length("label"))
        arrived = stored(arrived.where(F.col("end").isNull() | (F.col("at") == F.length("walk"))).select("walk", "backwards", "n", "at", "child", "child_parts", "end", "end_n"))
        found.append(arrived.where("end is not null"))
        further = arrived.where("end is null")
        if further.isEmpty():
            break
        further = further.select("walk", "backwards", "n", "at", F.col("child").alias("node"), part_of("walk", "child_parts").alias("part"), letter(walk, F.col("at")).alias("letter"))
        states = further.join(edges, ["node", "part", "letter"]).withColumn("given", F.lit(0))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.union(more)
    word = lambda c: F.when(F.col("backwards"), F.reverse(c)).otherwise(F.col(c))
    pairs = pairs.select(word("walk").alias("x"), word("end").alias("y"), F.col("n").alias("n_x"), F.col("end_n").alias("n_y"))
    pairs = pairs.where(F.levenshtein("x", "y", 1) == 1)
    first = F.col("x") < F.col("y")
    ordered = [F.when(first, F.col(p)).otherwise(F.col(q)).alias(name) for p, q, name in (("x", "y", "a"), ("y", "x", "b"), ("n_x", "n_y", "n_a"), ("n_y", "n_x", "n_b"))]
    return stored(pairs.select(*ordered).distinct())


def roots(links: DataFrame) -> DataFrame:
    """word, root of links (word, form): where the forms end. Every form occurs RATIO times as often as its word, so there
    are few steps, and each round doubles how many have been taken."""
    reached = stored(links.toDF("word", "root"))
    while True:
        beyond = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped = stored(reached.join(beyond, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if stepped.where("moved").isEmpty():
            return reached
        reached = stepped.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of each row of words (word, n)."""
    words = stored(words)
    pairs = near_pairs(words)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("other_n"))
    both = both.union(pairs.select("b", "a", "n_a"))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other"))).alias("best")
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), best)
    often = -F.col("best.less") >= ratio * F.col("n")
    formed = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(often, F.col("best.other")).alias("form"), F.when(often, -F.col("best.less")).alias("form_n")
    )
    formed = stored(formed)
    ended = roots(formed.where("form is not null").select("word", "form"))
    return formed.join(ended, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of the documents with their usual spelling."""
    return variants(word_counts(table(spark, sf_dir, "documents").select("doc_id", "text")))
