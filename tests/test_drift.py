import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.operators import drift


def values(spark, xs, labels=None):
    rows = [(i, float(x), None if labels is None else labels[i]) for i, x in enumerate(xs)]
    return spark.createDataFrame(rows, "TransactionID long, score double, y int")


def numpy_psi(a, b):
    edges = np.percentile(a, np.linspace(0, 100, 11))
    edges[0], edges[-1] = -np.inf, np.inf
    p = np.array([((a >= lo) & (a < hi)).mean() for lo, hi in zip(edges, edges[1:])])
    q = np.array([((b >= lo) & (b < hi)).mean() for lo, hi in zip(edges, edges[1:])])
    p, q = np.where(p == 0, 1e-6, p), np.where(q == 0, 1e-6, q)
    return float(((q - p) * np.log(q / p)).sum())


def uniform(seed, n, low=0.0, high=1.0):
    rng = np.random.RandomState(seed)
    return rng.uniform(low, high, n)


def test_psi_stable_and_shifted(spark):
    a, b, c = uniform(1, 1000), uniform(2, 1000), uniform(3, 1000, 0.7, 1.0)
    stable = drift.psi(values(spark, a), values(spark, b)).first()
    assert stable.psi < 0.1 and stable.psi == pytest.approx(numpy_psi(a, b))
    low = uniform(4, 1000, 0.0, 0.3)
    assert drift.psi(values(spark, low), values(spark, c)).first().psi > 0.2


def test_psi_with_repeated_edges(spark):
    a = np.array([1.0] * 34 + list(np.linspace(2, 3, 66)))
    b = np.array([1.0, 1.0, 1.0, 2.0, 2.5, 9.0, -4.0])
    assert drift.psi(values(spark, a), values(spark, b)).first().psi == pytest.approx(numpy_psi(a, b))


def test_feature_psi(spark):
    a, b = uniform(5, 300), uniform(6, 300)
    base = spark.createDataFrame([(float(x), float(10 * x)) for x in a], "p double, q double")
    cur = spark.createDataFrame([(float(x), float(1000 + x)) for x in b], "p double, q double")
    got = {r.feature: r.psi for r in drift.feature_psi(base, cur, ["p", "q"]).collect()}
    assert got["p"] == pytest.approx(numpy_psi(a, b)) and got["q"] > 1


def brute_ks(a, b):
    points = np.concatenate([a, b])
    return max(abs((a <= x).mean() - (b <= x).mean()) for x in points)


@pytest.mark.parametrize("digits", [1, 6])
def test_ks(spark, digits):
    a, b = np.round(uniform(7, 400), digits), np.round(uniform(8, 300, 0.1, 1.0), digits)
    row = drift.ks_test(values(spark, a), values(spark, b)).first()
    assert row.ks_stat == pytest.approx(brute_ks(a, b))
    lam = row.ks_stat * math.sqrt(400 * 300 / 700)
    p = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101))
    assert row.p_value == pytest.approx(min(1, max(0, p)), abs=1e-12)


def test_ks_of_equal_tables(spark):
    row = drift.ks_test(values(spark, [0.1, 0.2]), values(spark, [0.1, 0.2])).first()
    assert row.ks_stat == 0 and row.p_value == 1


def test_ks_per_group_equals_single_tests(spark):
    a = np.round(uniform(9, 300), 2)
    groups = {"x": np.round(uniform(10, 100, 0.2, 0.9), 2), "y": np.round(uniform(11, 50, -1, 2), 2)}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs]
    cur = spark.createDataFrame(rows, "g string, score double")
    got = {r.g: r.ks_stat for r in drift.ks_by(values(spark, a), cur, "g").collect()}
    assert got == pytest.approx({g: brute_ks(a, v) for g, v in groups.items()})
    index = {r.g: r.psi for r in drift.psi_by(values(spark, a), cur, "g").collect()}
    assert index == pytest.approx({g: numpy_psi(a, v) for g, v in groups.items()})


def test_alerts(spark):
    scores, labels = list(uniform(12, 500)), [1, 0] * 250
    base = values(spark, [0.9 if y else 0.1 for y in labels], labels)
    bad = values(spark, scores, labels)
    got = {r.metric: r for r in drift.drift_alerts(base, bad).collect()}
    assert set(got) == {"score_distribution_ks", "score_psi", "precision_drift", "recall_drift"}
    assert all(r.severity == "critical" for r in got.values())
    assert got["precision_drift"].baseline_value == 1.0
    assert "dropped from 1.0000 to" in got["precision_drift"].message
    assert drift.drift_alerts(base, base).count() == 0


def test_no_alerts_below_the_minimum(spark):
    base = values(spark, uniform(13, 200, 0, 0.3), [0] * 200)
    assert drift.drift_alerts(base, values(spark, uniform(14, 99, 0.7, 1), [1] * 99)).count() == 0
    assert drift.drift_alerts(base, values(spark, uniform(14, 100, 0.7, 1), [1] * 100)).count() > 0


def test_unlabelled_scores_raise_distribution_alerts_only(spark):
    base = values(spark, uniform(15, 200, 0, 0.3), [0, 1] * 100)
    cur = values(spark, uniform(16, 200, 0.7, 1.0))
    assert {r.metric for r in drift.drift_alerts(base, cur).collect()} == {"score_distribution_ks", "score_psi"}


def test_summary(spark):
    empty = spark.createDataFrame([], "TransactionID long, score double, y int")
    row = drift.drift_summary(empty, values(spark, [0.2, 0.8], [0, 1])).first()
    assert (row.window_size, row.fraud_rate, row.baseline_set, row.baseline_precision) == (2, 0.5, False, None)
    row = drift.drift_summary(values(spark, [0.9], [1]), empty).first()
    assert row.window_size == 0 and row.avg_fraud_score == 0 and row.baseline_set and row.baseline_recall == 1


# -- cooldown ----------------------------------------------------------------------------------


def greedy(times, gap):
    kept = []
    for t in sorted(times):
        if not kept or t - kept[-1] >= gap:
            kept.append(t)
    return kept


def alerts(spark, groups):
    rows = [(k, float(t)) for k, ts in groups.items() for t in ts]
    return spark.createDataFrame(rows, "metric string, t double").select(
        "metric", F.timestamp_micros((F.col("t") * 1e6).cast("bigint")).alias("event_time")
    )


def sent(df):
    out = {}
    for r in df.select("metric", (F.unix_micros("event_time") / 1e6).alias("t")).orderBy("t").collect():
        out.setdefault(r.metric, []).append(r.t)
    return out


def test_cooldown_cases(spark):
    times = [0, 1000, 3599, 3600, 5000, 7199, 7200, 20000]
    got = sent(drift.cooldown(alerts(spark, {"a": times, "b": [5]})))
    assert got == {"a": [0, 3600, 7200, 20000], "b": [5]}


@pytest.mark.parametrize("seed", [1, 2])
def test_cooldown_equals_the_greedy_rule(spark, seed):
    rng = random.Random(seed)
    groups = {
        "dense": [round(rng.uniform(0, 50_000), 3) for _ in range(400)],
        "sparse": [round(rng.uniform(0, 900_000), 3) for _ in range(60)],
        "repeated": [rng.choice([0, 1800, 3600, 5400, 9000]) for _ in range(50)],
    }
    got = sent(drift.cooldown(alerts(spark, groups)))
    assert got == {k: pytest.approx(greedy(ts, 3600)) for k, ts in groups.items()}


def test_last_n(spark):
    df = values(spark, uniform(17, 50)).withColumn("event_time", F.timestamp_seconds("TransactionID"))
    assert sorted(r.TransactionID for r in drift.last_n(df, 5).collect()) == [45, 46, 47, 48, 49]
