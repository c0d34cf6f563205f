import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from riskspark.functions import transaction as tx
from riskspark.operators import profiles
from riskspark.plans.features import build_features, drop_features, expected_features, feature_values
from riskspark.sources import io
from riskspark.sources.schema import FEATURES, TRANSACTION, VELOCITY, feature_columns


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_schema_sizes():
    assert len(TRANSACTION) == 35
    assert len(FEATURES) == 74 and len(set(FEATURES)) == 74
    assert all(f.nullable for f in TRANSACTION)


def test_feature_order_follows_the_model_not_the_table():
    assert feature_columns(["id_01", "C2", "other", "TransactionAmt"]) == ["TransactionAmt", "C2", "id_01"]
    assert drop_features(FEATURES, VELOCITY)[6] == "merchant_fraud_rate"


def test_haversine(spark):
    def km(a, b):
        return one(spark, d=tx.haversine_km(*[F.lit(float(x)) for x in (*a, *b)])).d

    assert km((40, -74), (40, -74)) == 0
    assert 3800 < km((40.7, -74.0), (34.05, -118.25)) < 4100


def test_cents_are_truncated_on_the_binary_product(spark):
    rows = spark.createDataFrame([(19.99,), (0.29,), (-19.99,)], "a double")
    assert [r[0] for r in rows.select(tx.amount_features(F.col("a"))["amt_cents"]).collect()] == [98, 28, 2]


def test_calendar(spark):
    saturday = F.lit(datetime(2017, 12, 2, 23)).cast("timestamp")
    row = one(spark, **tx.calendar_features(saturday))
    assert (row.tx_hour, row.tx_day_of_week, row.tx_is_weekend, row.tx_is_night) == (23, 5, 1, 1)


def test_clock_origin(spark):
    assert one(spark, t=F.date_format(tx.event_time(F.lit(86400)), "yyyy-MM-dd HH")).t == "2017-12-01 00"


def test_address_null_counts_as_zero(spark):
    row = one(spark, **tx.address_features(F.lit(None), F.lit(150.0)))
    assert row.addr_mismatch == 0 and row.addr_distance_km > 0


def test_decision_default_threshold(spark):
    for threshold in (None, 0.0):
        row = one(spark, **tx.decision_columns(F.lit(0.5), F.lit(0.06), F.lit(threshold).cast("double")))
        assert row.is_fraud and row.anomaly_flag


def test_card_statistics_and_unknown_cards(spark):
    train = spark.createDataFrame([(1, 10.0), (1, 20.0), (2, 5.0), (None, 99.0)], "card1 long, TransactionAmt double")
    stats = profiles.card_stats(train)
    known = {r.card1: r for r in stats.collect()}
    assert set(known) == {1, 2}
    assert known[2].card_std_amt == 0 and known[1].card_tx_count == 2
    test = spark.createDataFrame([(3, 11.0), (None, 11.0), (2, 5.0)], "card1 long, TransactionAmt double")
    rows = profiles.add_card_aggregates(test, stats).collect()
    unseen = [r for r in rows if r.card1 != 2]
    assert len(unseen) == 2
    for r in unseen:
        assert r.card_avg_amt == 10.0 and r.card_std_amt == 0 and r.card_tx_count == 0
        assert math.isclose(r.amt_zscore, 1e6)
    assert next(r for r in rows if r.card1 == 2).amt_zscore == 0


def test_risk_profile_strict_threshold_and_unmatched(spark):
    rows = [("a", 1)] + [("a", 0)] * 9 + [("b", 1), ("b", 0), (None, 1)]
    profile = profiles.risk_profile(spark.createDataFrame(rows, "ProductCD string, isFraud int"))
    assert profile.count() == 2
    test = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "ProductCD string")
    got = {r.ProductCD: r for r in profiles.add_merchant_risk(test, profile).collect()}
    assert [got[k].high_risk_merchant for k in ("a", "b", "c", None)] == [0, 1, 0, 0]
    assert got["c"].merchant_fraud_rate == 0 and got["c"].merchant_tx_count == 0


def test_identity_join_rate(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "TransactionID long")
    ids = spark.createDataFrame([(1,), (2,), (9,), (10,)], "TransactionID long")
    assert profiles.identity_join_rate(df, ids).first().join_rate == 0.5


def test_build_without_profile_fills_zero(spark):
    rows = [(1, 86400, 10.0, "W", 7, None), (2, 86500, None, "W", 7, 3.0)]
    df = spark.createDataFrame(rows, "TransactionID long, TransactionDT long, TransactionAmt double, ProductCD string, card1 long, D1 double")
    got = {r.TransactionID: r for r in build_features(df).collect()}
    assert got[1].D1 == 0 and got[1].merchant_fraud_rate == 0 and got[1].high_risk_merchant == 0
    assert got[2].TransactionAmt == 0 and got[2].velocity_count_1h == 1 and got[2].velocity_sum_1h == 10.0


def test_feature_vector_pads(spark):
    assert expected_features(["a", "b", "ae_anomaly_score", "ae_emb_0"]) == ["a", "b"]
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    assert list(df.select(*feature_values(df.columns, ["a", "b", "c"])).first()) == [1.0, 0.0, 0.0]


def test_dead_letters(spark):
    payloads = [
        '{"TransactionID":1,"TransactionDT":5,"TransactionAmt":3.5,"extra":1}',
        "{bad",
        '{"TransactionID":2,"TransactionDT":5,"TransactionAmt":-100}',
        '{"TransactionID":3,"TransactionAmt":1}',
        '{"TransactionID":4,"TransactionDT":5}',
        None,
    ]
    raw = spark.createDataFrame([(p, i) for i, p in enumerate(payloads)], "value string, offset long")
    df = io.with_error(io.parse_json_records(raw, keep=["offset"]))
    assert [r.TransactionID for r in io.valid_rows(df).collect()] == [1]
    bad = {r.original_offset: r for r in io.dead_letters(df, "t").collect()}
    assert [bad[i].error_type for i in range(1, 6)] == [
        "MalformedRecord", "InvalidAmount", "MissingTime", "MissingAmount", "MalformedRecord",
    ]
    assert bad[1].payload == "{bad" and bad[1].original_topic == "t"
    assert all(len(b.error_message) <= 500 for b in bad.values())


def test_json_records_turn_nan_into_null(spark):
    df = spark.createDataFrame([(1, float("nan"), None)], "TransactionID long, a double, b string")
    row = io.to_json_records(df).first()
    assert row.key == "1" and row.value == '{"TransactionID":1,"a":null,"b":null}'


def test_csv_sources(spark, tmp_path):
    (tmp_path / "tx.csv").write_text("TransactionAmt,TransactionID,V9,card1\n12.5,1,7,x\n,2,8,5\n")
    rows = io.read_transactions(spark, str(tmp_path / "tx.csv")).orderBy("TransactionID").collect()
    assert rows[0].TransactionAmt == 12.5 and rows[0].card1 is None and rows[1].TransactionAmt is None
    assert io.read_identity(spark, str(tmp_path / "missing.csv")) is None and io.read_identity(spark, None) is None
    (tmp_path / "id.csv").write_text("TransactionID,id_01\n1,2.0\n")
    assert io.read_identity(spark, str(tmp_path / "id.csv")).first().id_01 == 2.0


def test_table_and_metrics_files(spark, tmp_path):
    df = spark.createDataFrame([("W", 0.5, 2)], "ProductCD string, merchant_fraud_rate double, merchant_tx_count long")
    io.write_table(df, str(tmp_path / "risk"))
    assert io.read_features(spark, str(tmp_path / "risk")).collect() == df.collect()
    io.write_metrics(df, str(tmp_path / "metrics"))
    assert spark.read.json(str(tmp_path / "metrics")).count() == 1


@pytest.mark.parametrize("amount,valid", [(1.0, True), (0.0, False), (-1.0, False), (None, False)])
def test_valid_transaction(spark, amount, valid):
    assert one(spark, v=tx.valid_transaction(F.lit(1), F.lit(amount).cast("double"))).v is valid
