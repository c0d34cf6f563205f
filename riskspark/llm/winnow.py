"""Document fingerprints by winnowing, in DataFrame functions only.

A text's grams are runs of five lower-cased words (separated by ASCII white space). Of every four neighbouring gram
hashes the smallest is chosen, the rightmost of equal ones, and kept with its position. Two texts that share eight words
in a row therefore share at least one fingerprint hash.

Defined cases: a null text is empty and has no fingerprint, as has a text of white space; a text of fewer than five
words has one gram of all its words, and one of fewer than eight words one window. The likeness of two documents is the
Jaccard similarity of their sets of hashes, 1 if both are empty. Of rows that repeat a doc_id, each is fingerprinted, in
the order of their texts; the next document of the last of them has a smaller doc_id. Null doc_ids come last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskspark.llm.common import spread, table

WORDS, WINDOW = 5, 4
BLANK = " \t\n\x0b\x0c\r"
BUCKET_ROWS = 20_000


def word_hashes(text: Column) -> Column:
    body = F.btrim(F.lower(text), F.lit(BLANK))
    words = F.when(F.length(body) > 0, F.split(body, "[ \t\n\x0b\x0c\r]+")).otherwise(F.array().cast("array<string>"))
    return F.transform(words, lambda w: F.xxhash64(w))


def gram_hashes(words: Column) -> Column:
    """Hashes of the runs of WORDS words; of all words if there are fewer; none if there are none."""
    starts = F.sequence(F.lit(0), F.size(words) - WORDS)
    many = F.transform(starts, lambda i: F.xxhash64(*(words[i + k] for k in range(WORDS))))
    return F.when(F.size(words) >= WORDS, many).when(F.size(words) > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))


def chosen_positions(grams: Column) -> Column:
    """Positions of the window minima, ascending."""

    def rightmost(i: Column) -> Column:
        values = [grams[i + k] for k in range(WINDOW)]
        least, out = F.least(*values), i
        for k in range(1, WINDOW):
            out = F.when(values[k] == least, i + k).otherwise(out)
        return out

    windows = F.transform(F.sequence(F.lit(0), F.size(grams) - WINDOW), rightmost)
    last = F.size(grams) - F.array_position(F.reverse(grams), F.array_min(grams)).cast("int")
    return F.when(F.size(grams) >= WINDOW, F.array_distinct(windows)).when(F.size(grams) > 0, F.array(last)).otherwise(F.array().cast("array<int>"))


def fingerprints(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows`` with ``name`` (the chosen hashes, by position) and ``name``_at (their positions) of the column ``text``.

    Each step is a column of its own, so that a lambda reads a finished array instead of computing it again."""
    words, grams = f"{name}_words", f"{name}_grams"
    out = rows.withColumn(words, word_hashes(F.coalesce(F.col(text), F.lit(""))))
    out = out.withColumn(grams, gram_hashes(F.col(words))).drop(words)
    out = out.withColumn(f"{name}_at", chosen_positions(F.col(grams)))
    return out.withColumn(name, F.transform(f"{name}_at", lambda p: F.col(grams)[p])).drop(grams)


def likeness(a: str, b: str) -> Column:
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / both)


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_text: the text of the following row in descending doc_id; after the last, of the first.

    Rows are dealt once, into buckets of neighbouring ids whose borders are quantiles of doc_id. The first row of each
    bucket is also put at the end of the one before it, so that no window spans more than a bucket.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = rows.count()
    parts = spread(spark, n, BUCKET_ROWS)
    shares = [k / (4 * parts) for k in range(1, 4 * parts)]
    edges = rows.agg(F.percentile_approx("doc_id", shares, F.lit(100 * len(shares))).alias("e")).first()["e"] or []
    dealt = rows.withColumn("bucket", bucket_of(F.col("doc_id"), sorted(set(edges))))
    tops = dealt.select("bucket", "doc_id").groupBy("bucket").agg(F.max("doc_id").alias("doc_id")).collect()
    tops = sorted((r["bucket"], r["doc_id"]) for r in tops)
    # The highest row of a bucket follows the lowest of the bucket above; the very highest follows the very lowest.
    above = {doc_id: tops[(k + 1) % len(tops)][0] for k, (_, doc_id) in enumerate(tops)}
    borders = spark.createDataFrame([(k, v) for k, v in above.items()], "top long, above int")
    heads = rows.join(F.broadcast(borders), F.col("doc_id") == F.col("top")).groupBy("doc_id", "above").agg(F.min("text").alias("text"))
    # The wrap-around row must come after every id of its bucket, the others do anyway.
    heads = heads.select("doc_id", "text", F.col("above").alias("bucket"), F.lit(1).alias("tail"))
    order = W.partitionBy("bucket").orderBy("tail", F.col("doc_id").desc(), "text")
    both = dealt.select("doc_id", "text", "bucket", F.lit(0).alias("tail")).unionByName(heads)
    dealt_once = both.repartition(parts, "bucket")
    return dealt_once.withColumn("next_text", F.lead("text").over(order))


def bucket_of(value: Column, edges: list[int]) -> Column:
    """How many of the sorted ``edges`` are smaller than ``value``, by binary search."""
    borders = F.lit(edges) if edges else F.array().cast("array<bigint>")
    steps = F.lit([1 << k for k in range(len(edges).bit_length() - 1, -1, -1)] or [1])
    found = lambda at, step: F.when(F.get(borders, at + step - 1) < value, at + step).otherwise(at)
    return F.aggregate(steps, F.lit(0), found)


NULL_ID = -(1 << 63)


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are; see op7_winnowing for the columns."""
    rows = with_next(docs)
    order = W.partitionBy("bucket").orderBy("tail", F.col("doc_id").desc(), "text")
    rows = fingerprints(rows, "text", "marks").withColumn("next_marks", F.lead("marks").over(order)).where("tail = 0")
    n, cut = F.length("text"), F.floor(F.length("text") / 3)
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut))
    rows = fingerprints(rows.withColumn("n_chars", n.cast("long")).withColumn("edited", edited), "edited", "edited_marks")
    return rows.select(
        F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias("doc_id"), "text", "edited", "n_chars", "marks", "marks_at", "edited_marks", "edited_marks_at",
        likeness("marks", "edited_marks").alias("near_edited"), likeness("marks", "next_marks").alias("near_next"),
    )


def digest(name: str) -> Column:
    """A fixed-size digest of hashes and positions."""
    return F.sha2(F.concat_ws(",", F.col(name).cast("array<string>"), F.col(f"{name}_at").cast("array<string>")).cast("binary"), 256)


def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_chars, edited_sha256, digests of both fingerprints, near_edited, near_next of every document."""
    rows = compare_with_edits(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        digest("marks").alias("fingerprint"), digest("edited_marks").alias("edited_fingerprint"), "near_edited", "near_next",
    )
