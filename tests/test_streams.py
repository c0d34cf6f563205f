import random
from functools import reduce

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions.transaction import CLOCK_ORIGIN
from riskspark.operators import profiles
from riskspark.operators.drift import cooldown, drift_alerts, last_n
from riskspark.operators.velocity import velocity
from riskspark.plans.features import build_features
from riskspark.plans.model import Settings, fit_model
from riskspark.sources import io, views
from riskspark.sources.schema import TRANSACTION
from riskspark.streaming import drift, enrich, run
from riskspark.streaming.join import range_join
from riskspark.streaming.score import ScoringStream
from riskspark.streaming.sinks import TableSink, TopicSink, to_all
from riskspark.streaming.velocity import CELLS, SHORT, Windows, velocity_in_order, velocity_on_arrival, windows_of_cards

COLUMNS = ["TransactionID", "card1", "event_time", "TransactionAmt"]


@pytest.fixture(scope="module")
def events(spark, sf):
    return views.tx_events(spark, sf).cache()


def files_of(events, tmp_path, parts, jitter_seconds=0, seed=1):
    """Parquet files in arrival order: event time plus a random delay."""
    rng = random.Random(seed)
    pdf = events.toPandas()
    arrival = pdf["event_time"].astype("int64") // 10**9 + [rng.uniform(0, jitter_seconds) for _ in range(len(pdf))]
    pdf = pdf.assign(arrival=arrival).sort_values("arrival").drop(columns="arrival").reset_index(drop=True)
    size = -(-len(pdf) // parts)
    import os
    import time

    for i in range(parts):
        path = tmp_path / f"part-{i:03d}"
        events.sparkSession.createDataFrame(pdf[i * size : (i + 1) * size], events.schema).coalesce(1).write.parquet(str(path))
        for f in path.glob("*.parquet"):
            stamp = time.time() - 1000 + i
            os.utime(f, (stamp, stamp))
    return str(tmp_path)


def stream_of(spark, events, folder):
    return (
        spark.readStream.schema(events.schema)
        .option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .parquet(folder)
    )


def velocity_rows(df):
    names = [c for c in df.columns if c.startswith("velocity")]
    return {r.TransactionID: tuple(round(r[n], 4) for n in names) for r in df.collect()}


def with_end(events):
    """A row of an unknown card, far in the future, as the last file of a stream."""
    end = [(-1, -1, "2030-01-01 00:00:00", None)]
    row = events.sparkSession.createDataFrame(end, "TransactionID long, card1 long, event_time string, TransactionAmt double")
    return row.withColumn("event_time", F.col("event_time").cast("timestamp")).select(*[F.col(c).cast(t) for c, t in events.dtypes])


def closing(events, folder, k=999):
    import os
    import time

    path = f"{folder}/part-{k}"
    with_end(events).coalesce(1).write.parquet(path)
    for f in os.listdir(path):
        os.utime(f"{path}/{f}", (time.time(), time.time()))


def test_velocity_in_order_equals_batch_under_disorder(spark, events, tmp_path):
    small = events.select(*COLUMNS)
    folder = files_of(small, tmp_path / "in", 5, jitter_seconds=7200)
    closing(small, folder)
    stream = velocity_in_order(stream_of(spark, small, folder), late="3 hours")
    got = velocity_rows(run.run_to_table(stream, str(tmp_path / "out")).filter("TransactionID >= 0"))
    assert got == velocity_rows(velocity(small))


def test_velocity_in_order_keeps_every_column_and_rows_without_card(spark, tmp_path):
    rows = [(1, "a", 10.0, 5.25, "x", None), (2, "a", 11.0, None, None, 1), (3, None, 12.0, 1.0, "y", 2), (4, "a", 13.000001, 0.1, "z", 3), (5, "b", None, 4.0, "n", 4)]
    df = spark.createDataFrame(rows, "TransactionID long, card1 string, t double, TransactionAmt double, note string, k int")
    df = df.withColumn("event_time", F.timestamp_micros((F.col("t") * 1e6).cast("long"))).drop("t")
    end = spark.range(1).select(*[F.lit("2030-01-01").cast("timestamp").alias(c) if c == "event_time" else F.lit(None).cast(t).alias(c) for c, t in df.dtypes])
    stream = run.arriving(df.unionByName(end), F.when(F.col("TransactionID").isNull(), 1).otherwise(0), 2, str(tmp_path))
    out = run.run_to_table(velocity_in_order(stream, [1]), str(tmp_path / "run")).filter("TransactionID is not null")
    want = velocity(df, [1])
    assert sorted(map(str, out.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_late_rows_are_dropped_in_order_and_kept_on_arrival(spark, events, tmp_path):
    small = events.select(*COLUMNS)
    folder = files_of(small, tmp_path / "in", 6, jitter_seconds=10 * 86400)
    closing(small, folder)
    held = run.run_to_table(velocity_in_order(stream_of(spark, small, folder), late="1 hour"), str(tmp_path / "held"))
    assert 0 < held.filter("TransactionID >= 0").count() < small.count()
    at_once = run.run_to_table(velocity_on_arrival(stream_of(spark, small, folder)), str(tmp_path / "at_once"))
    assert at_once.filter("TransactionID >= 0").count() == small.count()


def test_velocity_on_arrival_sees_what_has_arrived(spark, tmp_path):
    files = [[(1, "a", 0, 1.0), (2, "a", 50, 2.0)], [(3, "a", 100, 4.0), (4, "a", 20, 8.0)], [(5, "a", 10, 16.0), (6, "a", 3700, 32.0), (7, "a", 3600 * 25, 64.0)]]
    rows = [(i, c, t, x, k) for k, part in enumerate(files) for i, c, t, x in part]
    df = spark.createDataFrame(rows, "TransactionID long, card1 string, t long, TransactionAmt double, part int")
    df = df.withColumn("event_time", F.timestamp_seconds("t")).drop("t")
    stream = run.arriving(df, F.col("part"), 3, str(tmp_path), files=1)
    out = run.run_to_table(velocity_on_arrival(stream), str(tmp_path / "run"))
    got = {r.TransactionID: (r.velocity_sum_1h, r.velocity_count_24h, r.velocity_sum_24h) for r in out.collect()}
    assert got == {1: (0, 0, 0), 2: (1, 1, 1), 3: (11, 3, 11), 4: (1, 1, 1), 5: (1, 1, 1), 6: (4, 5, 31), 7: (0, 1, 32)}


def test_velocity_on_arrival_of_blocks_that_share_a_key_in_one_part(spark, tmp_path):
    # Days 0 to 9 of one card come at once, and blocks of eight days apart meet in a key.
    rows = [(10 * d + i, "a", 86400 * d + 3600 * i, float(2**i)) for d in range(10) for i in range(4)]
    df = spark.createDataFrame(rows, "TransactionID long, card1 string, t long, TransactionAmt double")
    df = df.withColumn("event_time", F.timestamp_seconds("t")).drop("t")
    stream = run.arriving(df, F.lit(0), 1, str(tmp_path), files=1)
    got = velocity_rows(run.run_to_table(velocity_on_arrival(stream), str(tmp_path / "run")))
    assert got == velocity_rows(velocity(df))


def test_windows_of_many_cards_equal_brute_force():
    rng = random.Random(5)
    rows = [(f"c{min(rng.randrange(40), 12)}", rng.randrange(0, 2 * 86400) * 1_000_000, rng.choice([7.5, 1e6 + rng.random()])) for _ in range(900)]
    known = pd.DataFrame(rows, columns=["card", "at", "amount"])
    wanted = pd.concat([known[["card", "at"]].iloc[::3], pd.DataFrame({"card": ["none"], "at": [5]})], ignore_index=True)
    found = windows_of_cards((1, 24), known, wanted)
    assert found[1, 0].max() > SHORT > found[1, 0].min()
    for n, (card, t) in enumerate(wanted.itertuples(index=False)):
        for k, h in enumerate((1, 24)):
            x = [a for c, s, a in rows if c == card and t - h * 3_600_000_000 <= s < t]
            assert found[k, :, n] == pytest.approx((len(x), sum(x), np.std(x, ddof=1) if len(x) > 1 else 0), rel=1e-9, abs=1e-6)


def test_windows_of_a_key_equal_brute_force():
    rng = random.Random(3)
    at = sorted(rng.choice([rng.randrange(0, 3 * 86400), 3600 * rng.randrange(72)]) * 1_000_000 for _ in range(300))
    amount = [1e6 + rng.random() for _ in at]
    state = {}
    for low in range(0, 300, 60):
        held = Windows((1, 6, 24), lambda g: state.get(g), np.frombuffer(state.get("cells", b""), CELLS))
        for g in held.add(np.array(at[low : low + 60]), np.array(amount[low : low + 60])):
            state[g] = held.rows[g].tobytes()
        state["cells"] = held.cells.tobytes()
    found = Windows((1, 6, 24), lambda g: state.get(g), np.frombuffer(state["cells"], CELLS)).over(np.array(at))
    for n, t in enumerate(at):
        for k, h in enumerate((1, 6, 24)):
            x = [a for s, a in zip(at, amount) if t - h * 3_600_000_000 <= s < t]
            want = (len(x), sum(x), np.std(x, ddof=1) if len(x) > 1 else 0)
            assert found[k, :, n] == pytest.approx(want, rel=1e-9, abs=1e-6)


def test_range_join_equals_batch(spark, events, tmp_path):
    small = events.select(*COLUMNS)
    folder = files_of(small, tmp_path / "in", 4, jitter_seconds=7200)
    closing(small, folder)
    out = run.run_to_table(range_join(stream_of(spark, small, folder), 24, late="3 hours"), str(tmp_path / "out"))
    want = velocity(small.filter("card1 is not null"), [24], count_null_amounts=True)
    assert velocity_rows(out.filter("TransactionID >= 0")) == velocity_rows(want)


def test_tumbling_stream_equals_batch_on_closed_windows(spark, events, tmp_path):
    folder = files_of(events, tmp_path / "in", 4)
    newest = events.agg(F.max("event_time")).first()[0]
    for operator, late in ((enrich.tumbling_1h, "1 hour"), (enrich.tumbling_24h, "24 hours"), (enrich.tumbling_7d, "7 days")):
        got = run.run_to_table(operator(stream_of(spark, events, folder)), str(tmp_path / operator.__name__))
        batch = operator(events).filter(F.col("window_end") <= F.lit(newest) - F.expr(f"interval {late}"))
        rounded = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in batch.dtypes]
        assert got.count() == batch.count() > 0
        assert got.select(*rounded).exceptAll(batch.select(*rounded)).count() == 0


def test_weekly_mean_adds_up_in_order_of_time(spark, tmp_path):
    # 0.1 + 0.7 + ... in this order is not the sum of any other order.
    amounts = [0.1, 0.7, 1e15, 0.3, -1e15, 2.2, 0.05, 0.6]
    rows = [(1, 60 * i, x, i % 3) for i, x in enumerate(amounts)] + [(2, 0, None, 0), (-1, 86400 * 60, 1.0, 3)]
    df = spark.createDataFrame(rows, "card1 int, t long, TransactionAmt double, part int").withColumn("event_time", F.timestamp_seconds("t"))
    total = 0.0
    for x in amounts:
        total += x
    stream = run.arriving(df.drop("t"), F.col("part"), 4, str(tmp_path), files=2)
    for out in (run.run_to_table(enrich.tumbling_7d(stream), str(tmp_path / "run")), enrich.tumbling_7d(df)):
        assert {r.card1: r.card_avg_amt for r in out.filter("card1 > 0").collect()} == {1: total / len(amounts), 2: None}


def raw_messages(events):
    value = F.to_json(F.struct("TransactionID", "TransactionDT", "TransactionAmt", "ProductCD", "card1", "addr1", "addr2", "isFraud"))
    broken = F.when(F.col("TransactionID") % 10 == 0, F.substring(value, 1, 30)).when(
        F.col("TransactionID") % 10 == 1, F.regexp_replace(value, '"TransactionAmt":', '"TransactionAmt":-')
    ).otherwise(value)
    return events.select(F.col("TransactionID").alias("offset"), "event_time", broken.alias("value"))


def test_enriched_records_equal_batch_records(spark, events, tmp_path):
    raw = raw_messages(events)
    folder = files_of(raw, tmp_path / "in", 3)
    stream = stream_of(spark, raw, folder)
    writer = enrich.write_enriched(stream, str(tmp_path / "cp"), fmt="json", path=str(tmp_path / "out"), trigger={"availableNow": True})
    run.finish(writer.start())
    got = spark.read.schema("key string, value string").json(str(tmp_path / "out"))
    want = io.to_json_records(enrich.enrich(io.valid_rows(enrich.parse(raw))))
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0
    one = got.first().value
    assert '"log_amt"' in one and '"tx_is_night"' in one


def test_kafka_options_are_passed_on():
    class Reader:
        def __init__(self):
            self.seen = {}

        def format(self, f):
            self.seen["format"] = f
            return self

        def schema(self, s):
            return self

        def options(self, **o):
            self.seen |= o
            return self

        def load(self, *a):
            return self.seen

    class Session:
        readStream = Reader()

    got = enrich.read_stream(Session(), **{"kafka.bootstrap.servers": "h:1", "subscribe": "t"})
    assert got == {
        "format": "kafka", "startingOffsets": "latest", "failOnDataLoss": "false",
        "kafka.bootstrap.servers": "h:1", "subscribe": "t",
    }


@pytest.fixture(scope="module")
def small_model(events):
    train = events.drop("C1")
    risk, cards = profiles.risk_profile(train).cache(), profiles.card_stats(train).cache()
    names = ["TransactionAmt", "tx_hour", "velocity_count_24h", "amt_zscore"]
    built = build_features(train, risk, cards).select("TransactionID", "isFraud", *names).cache()
    return fit_model(built, names, Settings(rounds=2, depth=2, bottleneck=2)), risk, cards


def test_every_valid_row_is_scored_on_arrival(spark, events, small_model, tmp_path):
    model, risk, cards = small_model
    raw = raw_messages(events)
    folder = files_of(raw, tmp_path / "in", 5)
    base = str(tmp_path / "out")
    scoring = ScoringStream(
        model, risk, cards, to_all(TableSink(base, "scores"), TopicSink("TransactionID", "json", {"path": f"{base}/topic"})),
        to_all(TableSink(base, "dead_letters"), TopicSink("original_offset", "json", {"path": f"{base}/dead_topic"})), threshold=0.4, keep=["offset"],
    )
    run.finish(scoring.writer(stream_of(spark, raw, folder), str(tmp_path / "checkpoint"), availableNow=True).start())
    dead = run.all_batches(spark, base, "dead_letters")
    n = events.count()
    assert {r.error_type: r["count"] for r in dead.groupBy("error_type").count().collect()} == {
        "MalformedRecord": n // 10, "InvalidAmount": n // 10,
    }
    got = run.all_batches(spark, base, "scores")
    assert got.select("batch").distinct().count() == 5
    # The files come in the order of time, so what has arrived is the whole history.
    good = events.filter("TransactionID % 10 > 1").withColumn("event_time", F.timestamp_seconds(F.col("TransactionDT") + CLOCK_ORIGIN))
    assert got.count() == good.count() == got.select("TransactionID").distinct().count()
    batch = model.score(build_features(good, risk, cards)).select("TransactionID", F.col("raw_score").alias("want"))
    assert got.join(batch, "TransactionID").filter("abs(raw_score - want) < 1e-9").count() == good.count()
    topic = spark.read.json(f"{base}/topic")
    assert sorted(r.key for r in topic.collect()) == sorted(str(r.TransactionID) for r in got.collect())
    assert '"batch_id"' in topic.first().value and spark.read.json(f"{base}/dead_topic").count() == dead.count()


def test_a_replayed_batch_replaces_its_own_rows(spark, events, tmp_path):
    base = str(tmp_path)
    rows = events.select("TransactionID", "TransactionAmt")
    both = to_all(TableSink(base, "scores"), TopicSink("TransactionID", "json", {"path": f"{base}/topic"}))
    for sink_rows, batch in ((rows.limit(10), 0), (rows.limit(7), 1), (rows.limit(7), 1)):
        both(sink_rows, batch)
    assert run.all_batches(spark, base, "scores").count() == 17 == spark.read.json(f"{base}/topic").count()


def scores_at(spark, start, low, high, n=150, labelled=True):
    rng = random.Random(start)
    rows = [(start + i, float(start + i), rng.uniform(low, high), int(i % 5 == 0) if labelled else None) for i in range(n)]
    df = spark.createDataFrame(rows, "TransactionID long, t double, score double, y int")
    return df.select("TransactionID", F.timestamp_seconds("t").alias("event_time"), "score", "y")


def test_drift_stream_equals_the_batch_check_with_cooldown(spark, tmp_path):
    baseline = scores_at(spark, 0, 0.0, 0.4, 500)
    starts = [10_000, 11_000, 15_000, 20_000]
    parts = [scores_at(spark, s, 0.6 if s < 20_000 else 0.0, 1.0) for s in starts]
    everything = reduce(lambda a, b: a.unionByName(b), parts)
    which = sum(((F.col("TransactionID") >= s).cast("int") for s in starts[1:]), F.lit(0))
    stream = run.arriving(everything, which, 4, str(tmp_path / "in"))
    got = run.run_to_table(drift.drift_alert_stream(stream, baseline, window=200), str(tmp_path / "out"))
    want, last = [], {}
    for k, start in enumerate(starts):
        window = last_n(reduce(lambda a, b: a.unionByName(b), parts[: k + 1]), 200)
        now = (start + 149) * 1_000_000
        for r in drift_alerts(baseline, window).collect():
            if now - last.get(r.metric, -(10**18)) >= 3600 * 1_000_000:
                last[r.metric] = now
                want.append((now, r.metric, round(r.current_value, 9), r.severity, r.message))
    assert sorted((r.sent_us, r.metric, round(r.current_value, 9), r.severity, r.message) for r in got.collect()) == sorted(want)
    assert len({w[0] for w in want}) > 1 and len(want) < 4 * 4


def test_drift_stream_reads_the_baseline_once(spark, tmp_path):
    """Its scores may go after the first micro-batch, and no table is left behind by the stream."""
    baseline = scores_at(spark, 0, 0.0, 0.4, 300)
    later = scores_at(spark, 10_000, 0.6, 1.0, 300)
    stream = run.arriving(later, (F.col("TransactionID") >= 10_150).cast("int"), 2, str(tmp_path / "in"))
    alerts = drift.drift_alert_stream(stream, baseline, window=100, cooldown_seconds=1)
    plan = []
    query = alerts.writeStream.format("memory").queryName("alerts_once").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    run.finish(query)
    plan = [p.sources[0].numInputRows for p in query.recentProgress if p.sources[0].numInputRows]
    assert plan == [150, 150] and spark.table("alerts_once").select("sent_us").distinct().count() == 2


def test_stream_cooldown_equals_the_batch_rule(spark, tmp_path):
    rng = random.Random(4)
    rows = [(m, rng.randrange(0, 40_000) * 1_000_000) for m in ("a", "b") for _ in range(60)]
    df = spark.createDataFrame(rows, "metric string, sent_us long").distinct()
    stream = run.arriving(df, F.floor(F.col("sent_us") / 1e10).cast("int"), 4, str(tmp_path / "in"))
    got = run.run_to_table(drift.cooldown(stream), str(tmp_path / "out"))
    want = cooldown(df.withColumn("event_time", F.timestamp_micros("sent_us")))
    assert sorted(map(tuple, got.collect())) == sorted((r.metric, r.us) for r in want.select("metric", F.unix_micros("event_time").alias("us")).collect())


def test_redelivered_records_are_dropped(spark, events, tmp_path):
    twice = events.select(*COLUMNS).unionByName(events.select(*COLUMNS))
    folder = files_of(twice, tmp_path / "in", 2)
    out = run.run_to_table(enrich.deduplicate(stream_of(spark, twice, folder), late="1 day"), str(tmp_path / "run"))
    assert out.count() == events.count()


def test_stream_schema_is_the_transaction_schema(spark):
    row = enrich.parse(spark.createDataFrame([('{"TransactionID":1}',)], "value string")).first()
    assert row.error_type == "MissingTime" and set(TRANSACTION.names) <= set(row.asDict())
    assert isinstance(TRANSACTION["TransactionAmt"].dataType, T.DoubleType)


def test_state_has_few_partitions_a_core(spark, tmp_path):
    """A store of the state is opened in every micro-batch, so a session's many shuffle partitions aren't taken over."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    rows = spark.range(40).select("id", F.timestamp_seconds(1_700_000_000 + F.col("id") * 60).alias("event_time"))
    try:
        spark.conf.set(name, "50")
        stream = run.arriving(rows, (F.col("id") % 2).cast("int"), 2, str(tmp_path / "in"))
        out = run.run_to_table(enrich.deduplicate(stream, "id"), str(tmp_path / "out"))
        assert spark.conf.get(name) == "50"
    finally:
        spark.conf.set(name, before)
    stores = [p for p in (tmp_path / "out" / "checkpoint" / "state" / "0").iterdir() if p.name.isdigit()]
    assert len(stores) == run.STATE_PARTITIONS * spark.sparkContext.defaultParallelism == 16
    assert sorted(r.id for r in out.collect()) == list(range(40))


def test_slots_are_found_by_groups_of_cuts(spark):
    """Few comparisons a row, whatever the number of slots, and the same slots."""
    rng = np.random.default_rng(6)
    for n in (0, 1, 2, 3, 10, 99, 100, 4095):
        cuts = np.unique(rng.random(n)).tolist()
        values = [*rng.random(50).tolist(), *cuts[:20], *cuts[-3:], -1.0, 2.0]
        df = spark.createDataFrame([(x,) for x in values], "score double")
        found = [tuple(r) for r in df.select("score", drift.slot_of(cuts, F.col("score"))).collect()]
        assert found == [(x, int(np.searchsorted(cuts, x, "right"))) for x in values]


def test_slots_compare_a_row_with_few_cuts(spark):
    """Work on a row grows with the root of the number of slots."""
    import time

    df = spark.range(60_000, numPartitions=1).select((F.col("id") / 60_000).alias("score"))
    cuts = [i / 4096 for i in range(1, 4096)]

    def seconds(slot):
        start = time.monotonic()
        total = df.agg(F.sum(slot)).first()[0]
        return time.monotonic() - start, total

    flat = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("score")))
    slow, want = seconds(flat)
    fast, got = seconds(drift.slot_of(cuts, F.col("score")))
    assert got == want and fast < slow / 4
