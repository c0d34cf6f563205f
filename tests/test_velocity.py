import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskspark.operators.velocity import velocity

SCHEMA = "TransactionID long, card1 long, t long, TransactionAmt double"


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumn("event_time", F.timestamp_seconds("t")).drop("t")


def brute(rows, hours):
    out = {}
    for i, card, t, _ in rows:
        for h in hours:
            amounts = [
                a for _, c, s, a in rows
                if card is not None and c == card and a is not None and t - h * 3600 <= s < t
            ]
            std = float(np.std(amounts, ddof=1)) if len(amounts) > 1 else 0.0
            out[i, h] = (len(amounts), float(sum(amounts)), std)
    return out


def check(df, want, hours):
    for r in df.collect():
        for h in hours:
            n, s, d = want[r.TransactionID, h]
            assert r[f"velocity_count_{h}h"] == n, (r, h)
            assert r[f"velocity_sum_{h}h"] == pytest.approx(s, abs=1e-6)
            assert r[f"velocity_std_{h}h"] == pytest.approx(d, abs=1e-5)


def test_bounds_ties_and_nulls(spark):
    times = [0, 100, 100, 100, 3600, 3700, 3701]
    amounts = [1.0, 2.0, 4.0, 8.0, 16.0, None, 64.0]
    rows = [(i, 1, t, a) for i, (t, a) in enumerate(zip(times, amounts))]
    got = {r.TransactionID: r for r in velocity(frame(spark, rows), [1]).collect()}
    assert [got[i].velocity_count_1h for i in range(7)] == [0, 1, 1, 1, 4, 4, 1]
    assert [got[i].velocity_sum_1h for i in range(7)] == [0, 1, 1, 1, 15, 30, 16]
    stds = [0, 0, 0, 0, 3.095696, 6.191392, 0]
    assert [got[i].velocity_std_1h for i in range(7)] == pytest.approx(stds, abs=1e-5)


def test_missing_card_or_time_gives_zero(spark):
    rows = [(1, None, 0, 5.0), (2, None, 10, 5.0), (3, 1, None, 5.0), (4, 1, 10, 5.0), (5, 1, 20, 5.0)]
    got = {r.TransactionID: r.velocity_count_1h for r in velocity(frame(spark, rows), [1]).collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: 0, 5: 1}


def random_rows(seed, n=600):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # One card holds a third of all rows; times repeat and fall on grain borders.
        card = 0 if rng.random() < 0.34 else rng.choice([1, 2, 3, 4, None])
        t = rng.choice([rng.randrange(0, 4 * 86400), 3600 * rng.randrange(0, 96)])
        rows.append((i, card, t, None if rng.random() < 0.05 else round(rng.uniform(1, 500), 2)))
    return rows


@pytest.mark.parametrize("kwargs", [{}, {"grain_seconds": 600}])
def test_equals_brute_force(spark, kwargs):
    rows, hours = random_rows(7), [1, 6, 24]
    check(velocity(frame(spark, rows), hours, **kwargs), brute(rows, hours), hours)


def test_equals_pandas_rolling(spark):
    rows = [r for r in random_rows(8, 300) if r[1] is not None and r[3] is not None]
    seen, unique = set(), []
    for r in rows:
        if (r[1], r[2]) not in seen:
            seen.add((r[1], r[2]))
            unique.append(r)
    pdf = pd.DataFrame(unique, columns=["TransactionID", "card1", "t", "a"]).sort_values(["card1", "t"])
    pdf["dt"] = pd.to_datetime(pdf["t"], unit="s")
    rolled = pdf.set_index("dt").groupby("card1")["a"]
    pdf["n"] = rolled.transform(lambda x: x.rolling("6h", closed="left").count()).to_numpy()
    want = dict(zip(pdf["TransactionID"], pdf["n"].fillna(0)))
    got = {r.TransactionID: r.velocity_count_6h for r in velocity(frame(spark, unique), [6]).collect()}
    assert got == want


def test_hot_and_missing_cards_are_spread(spark):
    # A third of the rows has no card, a third has one card.
    rows = [(i, [None, 0, 1 + i % 40][i % 3], i * 60, 1.0) for i in range(3000)]
    df = frame(spark, rows).repartition(8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = velocity(df).withColumn("task", F.spark_partition_id()).select("card1", "task").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(out) == len(rows)
    for card in (None, 0):
        tasks = [r.task for r in out if r.card1 == card]
        assert len(set(tasks)) >= 4
        assert max(tasks.count(t) for t in set(tasks)) <= len(tasks) / 2


def test_rows_without_card_bypass_the_shuffle(spark):
    df = frame(spark, random_rows(9))
    plan = velocity(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lstrip().startswith("Union")


def test_history_counts_but_is_not_emitted(spark):
    rows = random_rows(10)
    cut = 2 * 86400
    old, new = [r for r in rows if r[2] < cut], [r for r in rows if r[2] >= cut]
    got = velocity(frame(spark, new), [24], history=frame(spark, old))
    assert got.count() == len(new)
    check(got, brute(rows, [24]), [24])


def test_row_counting_variant(spark):
    rows = [(1, 1, 0, None), (2, 1, 10, 5.0), (3, 1, 20, 5.0)]
    out = velocity(frame(spark, rows), [1], count_null_amounts=True)
    assert {r.TransactionID: r.velocity_count_1h for r in out.collect()} == {1: 0, 2: 1, 3: 2}


def test_equal_amounts_have_no_spread(spark):
    rows = [(i, 1, i * 60, 1e6 + 0.01) for i in range(200)]
    out = velocity(frame(spark, rows), [1, 6])
    assert max(abs(r.velocity_std_6h) for r in out.collect()) < 1e-4


def test_grain_must_divide_the_windows(spark):
    with pytest.raises(ValueError):
        velocity(frame(spark, [(1, 1, 0, 1.0)]), [1], grain_seconds=7)


def test_sparse_and_dense_cards_meet_in_one_table(spark, monkeypatch):
    """Cards with few rows a day go through range windows, the others by grains, and history counts for both."""
    from riskspark.operators import velocity as operator

    rows = random_rows(9)
    want = brute(rows, [1, 6, 24])
    ways = []
    for name in ("_ranges", "_grains"):
        plain = getattr(operator, name)
        monkeypatch.setattr(operator, name, lambda *a, plain=plain, name=name: ways.append(name) or plain(*a))
    for limit, expected in ((10**9, ["_ranges"]), (0, ["_ranges", "_grains"]), (20, ["_ranges", "_grains"])):
        monkeypatch.setattr(operator, "SPARSE", limit)
        ways.clear()
        got = velocity(frame(spark, rows), [1, 6, 24])
        assert got.count() == len(rows)
        check(got, want, [1, 6, 24])
        assert ways == expected
        early, late = [r for r in rows if r[0] % 2], [r for r in rows if not r[0] % 2]
        check(velocity(frame(spark, late), [1, 6, 24], history=frame(spark, early)), want, [1, 6, 24])
