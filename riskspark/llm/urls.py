"""URL filter: a policy list, and gradient-boosted trees on lexical features where the list is silent.

Features are the lengths of URL, host and path, the depth of both, shares of digits, hyphens, vowels and other symbols,
the entropy of the characters, the number of parameters, and for the last one and two labels of the host the smoothed
rate of blocked URLs among the labelled ones. All are DataFrame expressions; the trees are Spark's.

Defined cases: a null URL or one without "://" has an empty host and path, fits no rule and is judged by its features;
an empty host has the mean suffix rate; of several rules that fit, the longest wins (host and path together), then the
first by text; URLs of any length are read whole; rows that repeat are judged one by one.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.common import ascii_lower, table

FEATURES = [
    "n_url", "n_host", "n_path", "depth", "labels", "digits", "host_digits", "hyphens", "vowels", "symbols", "entropy", "parameters",
    "suffix1", "suffix2",
]
#: The policy list of the registered query, as verdict, host and path.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: Suffixes whose rates are kept: those with the most labelled URLs.
SUFFIXES = 1000
SMOOTHING = 20.0


def host_of(url: Column) -> Column:
    rest = F.substring_index(F.substring(url, F.locate("://", url) + 3, F.length(url)), "/", 1)
    host = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return F.when(F.locate("://", url) > 0, ascii_lower(host)).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    body = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    path = F.substring(body, F.length(F.substring_index(body, "/", 1)) + 1, F.length(body))
    return F.when(F.locate("://", url) > 0, path).otherwise(F.lit(""))


def ruled(urls: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``urls`` (host, path, ...) with rule and ruling, null where no rule fits. The list is a parameter, so it is bounded
    by what a person keeps; it becomes one expression and no join."""
    rule, ruling = F.lit(None).cast("string"), F.lit(None).cast("string")
    # From the weakest to the strongest, so that the last one that fits decides.
    for verdict, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), [-ord(c) for c in r[1] + r[2]])):
        own = (F.col("host") == host) | F.endswith("host", F.lit("." + host))
        fits = own & F.startswith("path", F.lit(path))
        rule, ruling = F.when(fits, host + path).otherwise(rule), F.when(fits, verdict).otherwise(ruling)
    return urls.withColumns({"rule": rule, "ruling": ruling})


def suffix(host: Column, labels: int) -> Column:
    return F.substring_index(host, ".", -labels)


def lexical(urls: DataFrame) -> DataFrame:
    """``urls`` (url, host, path, ...) with the features that need no statistics."""
    url = F.coalesce("url", F.lit(""))
    n = F.greatest(F.length(url), F.lit(1))
    share = lambda c, pattern: F.regexp_count(c, F.lit(pattern)) / F.greatest(F.length(c), F.lit(1))
    # One term for each distinct character.
    part = lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / n
    entropy = F.aggregate(F.array_distinct(F.split(url, "")), F.lit(0.0), lambda acc, c: acc - F.when(part(c) > 0, part(c) * F.log2(part(c))).otherwise(0.0))
    query = F.when(F.locate("?", url) > 0, F.substring_index(url, "?", -1)).otherwise(F.lit(""))
    return urls.withColumns({
        "n_url": F.length(url).cast("double"), "n_host": F.length("host").cast("double"), "n_path": F.length("path").cast("double"),
        "depth": F.regexp_count("path", F.lit("/[^/]")).cast("double"), "labels": F.regexp_count("host", F.lit("[.]")).cast("double"),
        "digits": share(url, "[0-9]"), "host_digits": share(F.col("host"), "[0-9]"), "hyphens": share(F.col("host"), "[-_]"),
        "vowels": share(F.col("host"), "[aeiou]"), "symbols": share(url, "[^A-Za-z0-9./:-]"), "entropy": entropy,
        "parameters": F.regexp_count(query, F.lit("[^=&]+=")).cast("double"),
    })


@dataclass(frozen=True)
class Filter:
    """The trees, and the rates of blocked URLs by suffix."""

    trees: PipelineModel
    rates: DataFrame
    mean: float


def parts_of(urls: DataFrame) -> DataFrame:
    url = F.coalesce("url", F.lit(""))
    return urls.withColumns({"host": host_of(url), "path": path_of(url)})


def with_rates(urls: DataFrame, rates: DataFrame, mean: float) -> DataFrame:
    """The rates are a table of at most SUFFIXES rows."""
    for k in (1, 2):
        own = rates.select(F.col("suffix").alias("of"), F.col("rate").alias("found"))
        urls = urls.join(F.broadcast(own), suffix(F.col("host"), k) == F.col("of"), "left").withColumn(f"suffix{k}", F.coalesce("found", F.lit(mean))).drop("of", "found")
    return urls


def train(labelled: DataFrame, rounds: int = 12, depth: int = 4) -> Filter:
    """The filter of a labelled table of url, blocked (0 or 1), which is as small as a person can label."""
    spark = labelled.sparkSession
    rows = lexical(parts_of(labelled.select("url", F.col("blocked").cast("double").alias("blocked"))))
    mean = rows.agg(F.avg("blocked")).first()[0] or 0.0
    both = rows.select("blocked", F.explode(F.array_distinct(F.array(suffix(F.col("host"), 1), suffix(F.col("host"), 2)))).alias("suffix"))
    found = both.groupBy("suffix").agg(F.count("*").alias("n"), F.sum("blocked").alias("bad")).orderBy(F.col("n").desc(), "suffix").limit(SUFFIXES).collect()
    table_of = [(r["suffix"], (r["bad"] + SMOOTHING * mean) / (r["n"] + SMOOTHING)) for r in found]
    rates = spark.createDataFrame(table_of, "suffix string, rate double")
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="point")
    trees = GBTClassifier(featuresCol="point", labelCol="blocked", maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=11)
    points = assembler.transform(with_rates(rows, rates, mean)).select("point", "blocked").coalesce(1)
    return Filter(PipelineModel([assembler, trees.fit(points)]), rates, mean)


def judge(urls: DataFrame, model: Filter, rules: list[tuple[str, str, str]]) -> DataFrame:
    """page_id, host, path, rule, verdict, score (the trees' probability to block) of each row of urls (page_id, url)."""
    rows = lexical(ruled(parts_of(urls.select("page_id", "url")), rules))
    scored = model.trees.transform(with_rates(rows, model.rates, model.mean))
    verdict = F.coalesce("ruling", F.when(F.col("prediction") == 1, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), vector_to_array("probability")[1].alias("score"))


def labelled_urls(spark: SparkSession, n: int = 2000, seed: int = 5) -> DataFrame:
    """A small labelled table made from patterns of wanted and unwanted addresses."""
    rnd = random.Random(seed)
    word = lambda low=3, high=9: "".join(rnd.choice(["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "es", "ti", "st", "en"]) for _ in range(rnd.randint(low, high) // 2))
    lure = ["casino", "bets", "win", "free", "cheap", "pills", "loans", "cash", "bonus", "slots", "prize", "adult", "deal", "click"]
    number = lambda low, high: str(rnd.randint(10 ** (low - 1), 10**high - 1))
    suffixes = ["example.com", "example.net", "example.org", "com", "net", "org"]

    def wanted() -> str:
        host = rnd.choice(["", "", "www.", "m.", "blog."]) + word() + "." + rnd.choice(suffixes)
        end = rnd.choice(["", "/", ".html", "#top", "?utm_source=feed", "?page=2&ref=x"])
        return f"{rnd.choice(['http', 'https'])}://{host}/{rnd.choice(['en', 'de', 'fr', 'es', word()])}/{number(1, 4)}{end}"

    def unwanted() -> str:
        host = rnd.choice([
            lambda: "-".join(rnd.sample(lure, rnd.randint(2, 3))), lambda: f"{word()}-{rnd.choice(lure)}{number(1, 3)}",
            lambda: "".join(rnd.choice("bcdfghjklmnpqrstvwxz0123456789") for _ in range(rnd.randint(10, 20))),
        ])()
        path = rnd.choice([
            lambda: f"{rnd.choice(['en', 'de', 'fr', 'es'])}/{number(1, 4)}{rnd.choice(['', '/', '.html', '#top'])}", lambda: f"{word()}/{number(6, 10)}/{number(6, 10)}",
            lambda: "?" + "&".join(f"{word(2, 4)}={number(4, 9)}" for _ in range(rnd.randint(3, 8))),
        ])()
        return f"{rnd.choice(['http', 'https'])}://{rnd.choice(['', 'www.', 'm.'])}{host}.{rnd.choice(suffixes)}/{path}"

    return spark.createDataFrame([(unwanted(), 1) if k % 3 == 0 else (wanted(), 0) for k in range(n)], "url string, blocked int")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    return judge(table(spark, sf_dir, "pages"), train(labelled_urls(spark)), RULES)
