"""Mixing sources to target weights by soft domain membership, in DataFrame functions only.

A labelled table (doc_id, domain) trains a multinomial logistic classifier on shape features and on counts of words that
are typical of a domain. It is fitted on at most ``sample`` labelled documents of each domain (a fixed hash order), which
is the only thing that is sampled. Labels count as far as their documents are in the input. Every document then has a posterior p over the domains and a number of tokens t, and
nonnegative rates r are fitted so that the expected domain totals, the sums of r t p, come to the target totals:
projected gradient on the weighted squared differences. A step needs one sum per domain
over all documents and changes every row by itself. Rows aren't moved: of the documents nothing but the ids is
shuffled, to see which labels count.

Defined cases: a null text is empty and has no tokens; an empty table gives an empty result; without labelled documents
every posterior is even; labels of documents that aren't there don't count; a domain that no document can belong to is
left out of the fit; of rows that repeat a doc_id each has its rate and its draw, the same for equal texts.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskspark.llm.common import stored, table

log = logging.getLogger(__name__)
SHAPES = ["log_words", "digits", "capitals", "symbols", "distinct", "word_length"]
#: Ranges of hashes by which labelled ids are counted: 2**SLICE_BITS rows a domain.
SLICE_BITS = 10
#: Target weights of the registered query and the pipeline.
TARGETS = {"good": 0.97, "poor": 0.02, "toxic": 0.01}


def domains_of(labels: DataFrame) -> DataFrame:
    """doc_id, domain of the table labels (doc_id, quality, toxic): toxic if any label says so, then poor, else good."""
    of = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").when(F.col("quality") == 1, "good")
    return of.select("doc_id", domain.alias("domain")).where("domain is not null")


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, "[ \t\n\x0b\x0c\r]+"), lambda w: w != "")


def among(words: list[str]) -> Callable[[Column], Column]:
    return lambda word: word.isin(words) if words else F.lit(False)


def features(docs: DataFrame, lexicon: dict[str, list[str]]) -> DataFrame:
    """``docs`` (with a column text) with tokens, the shape features and a count of typical words for each domain."""
    text, n = F.coalesce("text", F.lit("")), F.greatest(F.length("text"), F.lit(1))
    every = sorted({w for own in lexicon.values() for w in own})
    share = lambda pattern: F.regexp_count(text, F.lit(pattern)) / n
    out = docs.withColumns({"words": words_of(text), "digits": share("[0-9]"), "capitals": share("[A-Z]"), "symbols": share("[!#$%&*|=@+<>~^]")})
    out = out.withColumn("tokens", F.size("words").cast("long")).withColumn("typical", F.filter("words", among(every)))
    words = F.greatest("tokens", F.lit(1))
    out = out.withColumns({
        "log_words": F.log1p("tokens"), "distinct": F.size(F.array_distinct("words")) / words, "word_length": F.least(n / words, F.lit(50.0)),
    }).drop("words")
    hits = {f"hits_{d}": F.log1p(F.size(F.filter("typical", among(own)))) for d, own in lexicon.items()}
    return out.withColumns(hits).fillna(0.0, SHAPES).drop("typical")


def present(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """doc_id, domain of each labelled id that ``docs`` holds, once. Of the documents only ids move."""
    ids = docs.select("doc_id").distinct()
    return stored(labelled.dropDuplicates(["doc_id"]).join(ids, "doc_id", "left_semi").select("doc_id", "domain"))


def labelled_sample(docs: DataFrame, labelled: DataFrame, sample: int) -> DataFrame:
    """doc_id, text, domain of at most ``sample`` documents of each domain, of distinct labelled ids. Ids are chosen first and are few enough to be
    sent to the texts. Hashes are cut into 2**SLICE_BITS ranges; those that hold a domain's first ids are known from counts, and
    only their ids are put in order."""
    ids = labelled.withColumn("slice", F.shiftright(F.xxhash64("doc_id"), 64 - SLICE_BITS))
    before = F.coalesce(F.sum("n").over(W.partitionBy("domain").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    first = ids.groupBy("domain", "slice").agg(F.count("*").alias("n")).withColumn("before", before).where(F.col("before") < sample)
    place = F.row_number().over(W.partitionBy("domain").orderBy(F.xxhash64("doc_id"), "doc_id"))
    near = ids.join(F.broadcast(first.select("domain", "slice")), ["domain", "slice"])
    chosen = near.withColumn("place", place).where(F.col("place") <= sample).select("doc_id", "domain")
    return stored(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]))


def typical_words(rows: DataFrame, words: int = 40, least: int = 3, times: float = 5.0) -> dict[str, list[str]]:
    """For each domain, the words that occur in most of its documents, of those whose share of its documents is at
    least ``times`` their share of any other domain's and that ``least`` of its documents hold."""
    found = rows.select("doc_id", "domain", F.explode(F.array_distinct(words_of(F.coalesce("text", F.lit(""))))).alias("word"))
    counts = found.groupBy("domain", "word").agg(F.count("*").alias("n"))
    sizes = rows.groupBy("domain").agg(F.count("*").alias("size"))
    names = sorted(r["domain"] for r in sizes.collect())
    if not names:
        return {}
    wide = counts.join(F.broadcast(sizes), "domain").withColumn("share", F.col("n") / F.col("size"))
    of = lambda d, c: F.coalesce(F.max(F.when(F.col("domain") == d, F.col(c))), F.lit(0)).cast("double")
    both = stored(wide.groupBy("word").agg(*(of(d, c).alias(f"{c}{k}") for k, d in enumerate(names) for c in ("share", "n"))))
    out = {}
    for k, d in enumerate(names):
        others = [F.lit(0.0), F.lit(0.0), *(F.col(f"share{j}") for j in range(len(names)) if j != k)]
        own = both.where((F.col(f"n{k}") >= least) & (F.col(f"share{k}") >= times * F.greatest(*others)))
        out[d] = [r["word"] for r in own.orderBy(F.col(f"n{k}").desc(), "word").limit(words).select("word").collect()]
    return out


def scorer(docs: DataFrame, labelled: DataFrame, names: list[str], sample: int = 3000) -> Callable[[DataFrame], DataFrame]:
    """A function that adds tokens and posterior, an array of probabilities in the order of ``names``, to any table with
    a column text. The classifier is fitted on labelled rows of ``docs``."""
    labelled = present(docs, labelled.where(F.col("domain").isin(names)))
    rows = labelled_sample(docs, labelled, sample)
    lexicon = typical_words(rows)
    seen = [n for n in names if n in lexicon]
    inputs = SHAPES + [f"hits_{n}" for n in lexicon]
    if len(seen) < 2:
        even = [F.lit(1.0 if n in seen else 0.0) if seen else F.lit(1.0 / len(names)) for n in names]
        return lambda d: d.withColumn("tokens", F.size(words_of(F.coalesce("text", F.lit("")))).cast("long")).withColumn("posterior", F.array(*even))
    domain = reduce(lambda c, k: c.when(F.col("domain") == seen[k], float(k)), range(1, len(seen)), F.when(F.col("domain") == seen[0], 0.0))
    points = VectorAssembler(inputCols=inputs, outputCol="point").transform(features(rows, lexicon).withColumn("class", domain))
    model = LogisticRegression(featuresCol="point", labelCol="class", family="multinomial", regParam=1e-4, maxIter=100).fit(stored(points.select("point", "class")))
    weights, offsets = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    # The sample has other shares of the domains than the labelled documents of the input; the posterior must have the latter's.
    taken, there = ({r["domain"]: r["n"] for r in d.groupBy("domain").agg(F.count("*").alias("n")).collect()} for d in (rows, labelled))
    offsets = offsets + np.array([np.log(there[n] / taken[n]) for n in seen])
    logits = [sum((F.col(c) * float(w) for c, w in zip(inputs, weights[k], strict=True)), F.lit(float(offsets[k]))) for k in range(len(seen))]
    powers = [F.exp(F.col("logits")[k] - F.col("top")) for k in range(len(seen))]
    total = sum((F.col("powers")[k] for k in range(1, len(seen))), F.col("powers")[0])
    shares = [F.col("powers")[seen.index(n)] / total if n in seen else F.lit(0.0) for n in names]

    def score(d: DataFrame) -> DataFrame:
        out = features(d, lexicon).withColumn("logits", F.array(*logits)).withColumn("top", F.array_max("logits"))
        return out.withColumn("powers", F.array(*powers)).withColumn("posterior", F.array(*shares)).drop("logits", "top", "powers", *inputs)

    return score


def rate_after(steps: list[np.ndarray]) -> Column:
    """A row's rate after the given steps: each moves it against its posterior's share of the domains' gaps, not below 0."""
    rate = F.lit(1.0)
    for weights in steps:
        slope = sum((F.col("posterior")[j] * float(w) for j, w in enumerate(weights)), F.lit(0.0))
        rate = F.greatest(F.lit(0.0), rate - slope)
    return rate


def goals(own: np.ndarray, targets: np.ndarray, budget: float | None) -> np.ndarray:
    """The domain totals to come to. Without a budget, the domain with the largest target is taken as it is, and a domain
    that has less than its target then asks for is taken as it is too, so that no domain has to be repeated. The target
    weights aren't met then; fit_rates says so (see missed)."""
    if budget is not None:
        return targets * budget
    main = int(targets.argmax())
    return np.minimum(targets * own[main] / targets[main], own) if own[main] > 0 else own


def missed(goal: np.ndarray, targets: np.ndarray) -> dict[int, float]:
    """The domains whose share of the goals differs from their target weight, with that share."""
    shares = goal / goal.sum() if goal.sum() else goal
    return {k: float(shares[k]) for k in range(len(targets)) if abs(shares[k] - targets[k]) > 1e-6}


def fit_rates(rows: DataFrame, targets: list[float], budget: float | None = None, rounds: int = 30, tolerance: float = 1e-5, names: list[str] | None = None) -> list[np.ndarray]:
    """The steps that bring the expected domain totals of ``rows`` (tokens, posterior) to the targets. Target weights that
    the totals can't meet are logged as warnings, with the ``names`` of the domains.

    Differences are weighted by the inverse of the domains' second moments. Taken over all rows, these bound the
    curvature by 1, so that a step of length 1 always descends; taken over the rows whose rate isn't 0, a step is exact
    until the next rate is cut off. The latter are used as long as the differences get smaller. A step is one number per
    domain, so a row's rate is an expression over the row and no table of rates is kept between steps.
    """
    d = range(len(targets))
    p, t, rate = [F.col("posterior")[k] for k in d], F.col("tokens"), F.col("rate")
    sums = [F.sum(rate * t * p[k]) for k in d] + [F.sum(F.when(rate > 0, t * p[j] * p[k])) for j in d for k in d]
    steps: list[np.ndarray] = []
    own = moments = goal = before = None
    for k in range(rounds + 1):
        found = rows.withColumn("rate", rate_after(steps)).agg(*(c.alias(f"s{j}") for j, c in enumerate(sums))).first()
        row = np.array([v or 0.0 for v in found])
        totals, active = row[: len(d)], row[len(d) :].reshape(len(d), len(d))
        if own is None:
            own, moments = totals, active
            if not own.sum():
                break
            goal = goals(own, np.array(targets), budget)
            # A domain that no document can belong to has no share, whatever its goal is.
            for j, share in missed(np.where(own > 0, goal, 0.0), np.array(targets)).items():
                log.warning("mixing: domain %s gets a weight of %.6f, its target is %.6f", names[j] if names else j, share, targets[j])
        gap = np.where(own > 0, totals - goal, 0) / own.sum()
        if np.abs(gap).max() < tolerance or k == rounds:
            break
        if before is None or np.abs(gap).sum() < before:
            before, weight = np.abs(gap).sum(), active
        else:
            before, weight = -1.0, moments
        steps.append(np.linalg.pinv(weight / own.sum(), rcond=1e-9, hermitian=True) @ gap)
    return steps


def copies_of(rate: Column, doc_id: Column, steady: float = 0.1) -> Column:
    """How often a document is taken: its rate if that is within ``steady`` of a whole number, else the rate's floor or
    ceiling, drawn by the hash of the doc_id. The expectation is the rate only if ``steady`` is 0: mixing passes that."""
    chance = F.pmod(F.xxhash64(F.lit("mix"), doc_id), F.lit(1 << 20)) / float(1 << 20)
    return F.when(F.abs(rate - F.round(rate)) <= steady, F.round(rate)).otherwise(F.floor(rate + chance)).cast("long")


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], budget: float | None = None) -> DataFrame:
    """doc_id, source, tokens, posterior, rate, copies of each row of ``docs`` (doc_id, text, source).

    ``targets`` are weights of domains, scaled to 1. ``budget`` is the number of tokens to come to, by default what takes
    the largest target's domain whole and repeats no domain (see goals). The expectation of copies is the rate.
    """
    names, total = sorted(targets), sum(targets.values())
    rows = stored(scorer(docs, labelled, names)(docs.select("doc_id", "text", "source")).select("doc_id", "source", "tokens", "posterior"))
    steps = fit_rates(rows, [targets[n] / total for n in names], budget, names=names)
    return rows.withColumn("rate", rate_after(steps)).withColumn("copies", copies_of(F.col("rate"), F.col("doc_id"), steady=0.0))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posteriors, rates and copies of every document for the target weights of good, poor and toxic text."""
    out = mix(table(spark, sf_dir, "documents"), domains_of(table(spark, sf_dir, "labels")), TARGETS)
    return out.select("doc_id", "source", "tokens", *(F.col("posterior")[k].alias(f"p_{n}") for k, n in enumerate(sorted(TARGETS))), "rate", "copies")


def resampled(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], budget: float | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as its rate says. Rows are scored where they are, once for the fit and once
    for the result, so that no join moves texts."""
    names, total = sorted(targets), sum(targets.values())
    score = scorer(docs, labelled, names)
    fitted = stored(score(docs.select("text")).select("tokens", "posterior"))
    steps = fit_rates(fitted, [targets[n] / total for n in names], budget, names=names)
    rows = score(docs.select("text", F.struct(*docs.columns).alias("row")))
    out = rows.withColumn("copies", copies_of(rate_after(steps), F.col("row.doc_id"), steady=0.0))
    return out.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("row.*")
