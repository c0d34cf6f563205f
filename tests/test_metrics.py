import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.operators import metrics, sampling
from riskspark.operators.ranking import cumulative, exact_percentiles, hash_rank


def scored(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "TransactionID long, y int, p double")


def random_scores(seed, n=400, hot=0.34):
    """A third of the rows share one score."""
    rng = random.Random(seed)
    return [
        (int(rng.random() < 0.3), 0.25 if rng.random() < hot else round(rng.random(), 2)) for _ in range(n)
    ]


def brute_auc(rows):
    y, p = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    ap, last = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        tp = ((p >= t) & (y == 1)).sum()
        recall = tp / y.sum()
        ap += (recall - last) * tp / (p >= t).sum()
        last = recall
    pos, neg = p[y == 1], p[y == 0]
    wins = sum((a > neg).sum() + 0.5 * (a == neg).sum() for a in pos)
    return ap, wins / (len(pos) * len(neg))


@pytest.mark.parametrize("seed", [1, 2])
def test_auc_equals_brute_force(spark, seed):
    rows = random_scores(seed)
    got = metrics.auc(scored(spark, rows), "p").first()
    assert (got.auc_pr, got.auc_roc) == pytest.approx(brute_auc(rows))
    full = metrics.evaluate(scored(spark, rows), "p").first()
    assert (full.auc_pr, full.auc_roc) == pytest.approx(brute_auc(rows))
    assert full.true_positives == sum(1 for y, p in rows if y == 1 and p >= 0.5)
    assert full.true_negatives == sum(1 for y, p in rows if y == 0 and p < 0.5)


def test_auc_per_group_with_a_null_group(spark):
    a, b = random_scores(3), random_scores(4, 100)
    rows = [(None, *r) for r in a] + [("g", *r) for r in b]
    df = spark.createDataFrame(rows, "g string, y int, p double")
    got = {r.g: (r.auc_pr, r.auc_roc) for r in metrics.auc(df, "p", by=["g"]).collect()}
    assert got[None] == pytest.approx(brute_auc(a)) and got["g"] == pytest.approx(brute_auc(b))


@pytest.mark.parametrize("buckets", [1, 3, 64])
@pytest.mark.parametrize("descending", [False, True])
def test_cumulative_does_not_depend_on_buckets(spark, buckets, descending):
    rows = random_scores(5)
    df = scored(spark, rows)
    got = cumulative(df, "p", {"n": F.lit(1), "s": F.col("y")}, descending=descending, buckets=buckets).collect()
    assert len(got) == len({p for _, p in rows})
    for r in got:
        inside = [y for y, p in rows if (p >= r.p if descending else p <= r.p)]
        assert (r.cum_n, r.cum_s, r.total_n) == (len(inside), sum(inside), len(rows))


def test_cumulative_keeps_null_and_nan(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (1.0,), (2.0,)], "v double")
    assert cumulative(df, "v", {"n": F.lit(1)}).agg(F.sum("n")).first()[0] == 4


def test_percentiles(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (8.0,), (None,)], "v double")
    assert exact_percentiles(df, "v", [0.1, 0.5, 0.95]).first()[0] == pytest.approx([1.3, 3.0, 7.4])
    rows = [(p,) for _, p in random_scores(6, 999)]
    got = exact_percentiles(spark.createDataFrame(rows, "v double"), "v", [0, 0.25, 0.333, 1], buckets=7).first()[0]
    assert got == pytest.approx(list(np.percentile([r[0] for r in rows], [0, 25, 33.3, 100])))


def test_no_predicted_positives(spark):
    df = scored(spark, [(1, 0.1), (0, 0.2)])
    row = metrics.evaluate(df, "p", threshold=0.9).first()
    assert row.precision == 0 and row.recall == 0 and row.f1 == 0 and row.false_negative_rate == 1
    assert metrics.threshold_sweep(df, "p").count() == 0
    m = metrics.model_metrics(df, "p", threshold=0.9).first()
    assert m.precision == 0 and m.recall == 0 and m.n_flagged == 0


def test_one_class_only(spark):
    assert metrics.auc(scored(spark, [(0, 0.1), (0, 0.3)]), "p").first().auc_roc == 0
    weight = metrics.class_weight(scored(spark, [(0, 0.1), (0, 0.3)]), "y").first()
    assert weight.scale_pos_weight == 2


def test_report_averages(spark):
    rows = random_scores(7)
    got = {r["class"]: r for r in metrics.classification_report(scored(spark, rows), "p").collect()}
    macro = (got["0"].precision + got["1"].precision) / 2
    assert got["macro avg"].precision == pytest.approx(macro)
    assert got["weighted avg"].support == len(rows)
    assert got["accuracy"].f1 == pytest.approx(sum(1 for y, p in rows if (p >= 0.5) == (y == 1)) / len(rows))


def test_pr_curve_starts_at_the_lowest_threshold(spark):
    rows = random_scores(8)
    got = metrics.pr_curve(scored(spark, rows), "p", points=5).collect()
    assert [r.threshold for r in got] == sorted({p for _, p in rows})[:5]
    assert got[0].recall == 1


def test_ablation_summary(spark):
    table = spark.createDataFrame(
        [("full", 0.1655, 0.141), ("a", 0.158, 0.119), ("b", 0.2163, 0.239), ("c", 0.4538, 0.21)],
        "variant string, precision double, false_negative_rate double",
    )
    row = metrics.ablation_summary(table, "full", ["a", "b", "c"]).first()
    assert round(row.precision_improvement_pct, 2) == -63.53
    assert round(row.fnr_reduction_pct, 2) == -18.49


# -- sampling ----------------------------------------------------------------------------------


def labelled(spark, n=1000, every=10):
    return spark.range(n).select(
        F.col("id").alias("TransactionID"), (F.col("id") % every == 0).cast("int").alias("isFraud")
    )


def test_hash_rank_is_a_permutation_per_group(spark):
    df = labelled(spark).withColumn("isFraud", F.when(F.col("TransactionID") > 5, F.col("isFraud")))
    for r in hash_rank(df, "s", by=["isFraud"], buckets=5).groupBy("isFraud").agg(
        F.sort_array(F.collect_list("hash_rank")).alias("ranks"), F.max("group_rows").alias("n")
    ).collect():
        assert r.ranks == list(range(r.n))


def test_stratified_split_is_exact_and_independent_of_partitions(spark):
    df = labelled(spark, 1003)
    split = sampling.stratified_split(df)
    counts = {r.isFraud: (r.train, r.n) for r in split.groupBy("isFraud").agg(
        F.sum(F.col("is_train").cast("int")).alias("train"), F.count("*").alias("n")).collect()}
    assert counts == {1: (81, 101), 0: (722, 902)}
    again = sampling.stratified_split(df.repartition(9))
    assert split.exceptAll(again).count() == 0


def test_split_does_not_shuffle_the_table(spark):
    split = sampling.stratified_split(labelled(spark))
    assert "Exchange" not in split._jdf.queryExecution().executedPlan().toString()


def test_folds_and_samples(spark):
    df = labelled(spark, 1000)
    folds = sampling.kfold(df, 5).groupBy("fold").agg(F.sum("isFraud").alias("f"), F.count("*").alias("n")).collect()
    assert sorted((r.f, r.n) for r in folds) == [(20, 200)] * 5
    sample = sampling.stratified_sample(df, 200)
    assert (sample.count(), sample.filter("isFraud = 1").count()) == (200, 20)
    sample = sampling.importance_sample(df, 200)
    assert (sample.count(), sample.filter("isFraud = 1").count()) == (200, 60)
    assert sampling.stratified_sample(df, 5000).count() == 1000
    assert sampling.first_by_hash(df, "1", 17).count() == 17


def test_folds_are_dealt_in_turn_by_rank(spark):
    df = labelled(spark, 1003)
    folds = {r.TransactionID: r.fold for r in sampling.kfold(df, 5).collect()}
    ranked = hash_rank(df, "42", "TransactionID", ["isFraud"]).collect()
    assert len(ranked) == 1003 and all(folds[r.TransactionID] == r.hash_rank % 5 for r in ranked)


def test_split_of_an_empty_table(spark):
    assert sampling.stratified_split(labelled(spark).filter("false")).count() == 0
