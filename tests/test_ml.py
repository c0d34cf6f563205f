import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.functions.text import fixed
from riskspark.ml import anomaly, attribute, calibrate, classify
from riskspark.ml.attribute import Leaf, batch_contributions, expected_margin, read_leaves
from riskspark.ml.scale import fit_scaler
from riskspark.ml import smote as smote_module
from riskspark.ml import trim
from riskspark.ml.smote import nearest_neighbours, smote
from riskspark.operators import attribution, metrics
from riskspark.plans import reports, training
from riskspark.plans.model import RiskModel, Settings, fit_model
from riskspark.plans.scoring import explain_batch, score_batch
from riskspark.sources import io, views

NAMES = ["a", "b", "c", "d"]
TINY = Settings(rounds=4, depth=3, bottleneck=2)


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        a, b, c = rng.gauss(0, 1), rng.uniform(0, 5), rng.gauss(2, 3)
        y = int(a + 0.3 * b + rng.gauss(0, 0.5) > 2)
        rows.append((i, y, a, b, c, 7.0, None if i % 50 == 0 else 10 + 5 * a))
    schema = "TransactionID long, isFraud int, a double, b double, c double, d double, TransactionAmt double"
    return spark.createDataFrame(rows, schema).cache()


@pytest.fixture(scope="module")
def model(spark, table, tmp_path_factory):
    fitted = fit_model(table, NAMES, TINY)
    path = str(tmp_path_factory.mktemp("model"))
    fitted.save(spark, path)
    return fitted, path


def test_scaler_uses_population_std_and_keeps_constants(table):
    scaler = fit_scaler(table, NAMES)
    a = [r.a for r in table.collect()]
    assert scaler.mean[0] == pytest.approx(np.mean(a)) and scaler.scale[0] == pytest.approx(np.std(a))
    assert scaler.scale[3] == 1.0
    row = table.select(*scaler.values()).agg(F.avg("z_a"), F.stddev_pop("z_a"), F.max("z_d")).first()
    assert list(row) == pytest.approx([0, 1, 0], abs=1e-9)


def test_anomaly_score(table):
    scaler = fit_scaler(table, NAMES[:3])
    rows = table.select("TransactionID", "isFraud", *scaler.values())
    full = anomaly.fit_anomaly(rows, scaler.names, k=16)
    assert full.getK() == 3
    assert anomaly.anomaly_scores(rows, full, scaler.names).agg(F.max("ae_anomaly_score")).first()[0] < 1e-12
    small = anomaly.fit_anomaly(rows, scaler.names, k=2)
    got = anomaly.anomaly_scores(rows, small, scaler.names).collect()
    x = np.array([[r[n] for n in scaler.names] for r in got])
    v = small.pc.toArray()
    want = ((x - x @ v @ v.T) ** 2).mean(axis=1)
    assert [r.ae_anomaly_score for r in got] == pytest.approx(list(want))
    assert all(r.ae_anomaly_score >= 0 for r in got)


def brute_shapley(leaves, x):
    """Over all subsets, with the tree's own cover shares for the features left out."""
    m = len(x)

    def value(subset):
        total = 0.0
        for leaf in leaves:
            p = leaf.value
            for f, low, high, share in zip(leaf.features, leaf.low, leaf.high, leaf.share):
                p *= float(low < x[f] <= high) if f in subset else share
            total += p
        return total

    out = []
    for i in range(m):
        rest = [j for j in range(m) if j != i]
        phi = 0.0
        for size in range(m):
            weight = math.factorial(size) * math.factorial(m - size - 1) / math.factorial(m)
            for s in itertools.combinations(rest, size):
                phi += weight * (value({*s, i}) - value(set(s)))
        out.append(phi)
    return out


def test_contributions_equal_brute_force_shapley(spark, table):
    columns = NAMES[:3]
    rows = table.select("TransactionID", "isFraud", *columns)
    fitted = classify.fit_trees(rows, columns, rounds=3, depth=3)
    import tempfile

    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/m"
    fitted.write().save(path)
    leaves = read_leaves(spark, path, list(fitted.treeWeights))
    x = np.array([[r[c] for c in columns] for r in rows.limit(20).collect()])
    got = batch_contributions(x, leaves)
    for row, phi in zip(x, got):
        assert list(phi) == pytest.approx(brute_shapley(leaves, row), abs=1e-9)


def test_leaves_are_looked_up_in_groups():
    """A chain of nine features, then a full tree of depth 3: leaves with more conditions than a group, and groups of leaves."""
    inf, leaves, way = math.inf, [], {}
    for f in range(9):
        leaves.append(Leaf(1.0 + f, (*way, f), (*([-inf] * f), 0.5), (*([0.5] * f), inf), (*way.values(), 0.25)))
        way[f] = 0.75
    leaves.append(Leaf(-3.0, tuple(way), (-inf,) * 9, (0.5,) * 9, tuple(way.values())))
    for sides in itertools.product((0, 1), repeat=3):
        low, high = tuple(0.3 if s else -inf for s in sides), tuple(inf if s else 0.3 for s in sides)
        leaves.append(Leaf(float(sum(sides)) - 0.7, (0, 4, 8), low, high, tuple(0.6 if s else 0.4 for s in sides)))
    _, groups = attribute.grouped(leaves)
    assert len(groups) < len(leaves) / 2
    x = np.random.default_rng(5).random((40, 9))
    x[0] = 0.5
    for row, phi in zip(x, batch_contributions(x, leaves)):
        assert list(phi) == pytest.approx(brute_shapley(leaves, row), abs=1e-9)


def test_repeated_feature_on_one_path():
    leaves = [
        Leaf(1.0, (0,), (-math.inf,), (0.0,), (0.5,)),
        Leaf(3.0, (0,), (0.0,), (1.0,), (0.25,)),
        Leaf(9.0, (0,), (1.0,), (math.inf,), (0.25,)),
        Leaf(2.0, (), (), (), ()),
    ]
    x = np.array([[0.5], [5.0], [0.0]])
    assert expected_margin(leaves) == pytest.approx(0.5 + 0.75 + 2.25 + 2.0)
    assert batch_contributions(x, leaves)[:, 0] == pytest.approx([3 - 3.5, 9 - 3.5, 1 - 3.5])


def test_contributions_add_up_to_the_margin(table, model):
    fitted, path = model
    phi = fitted.contributions(table, path, keep=["TransactionID"])
    scores = fitted.score(table)
    margin = F.ln(F.col("raw_score") / (1 - F.col("raw_score"))) / 2
    gap = phi.join(scores, "TransactionID").select(F.abs(F.col("sum_shap") + F.col("expected_value") - margin).alias("g"))
    assert gap.agg(F.max("g")).first()[0] < 1e-6


def test_reloaded_model_gives_equal_scores(spark, table, model):
    fitted, path = model
    again = RiskModel.load(spark, path)
    assert again.features == NAMES and again.anomaly_threshold == fitted.anomaly_threshold
    both = fitted.score(table).join(again.score(table).withColumnRenamed("fraud_score", "other"), "TransactionID")
    assert both.filter("fraud_score <> other").count() == 0


@pytest.mark.parametrize("method", ["platt", "isotonic", "temperature"])
def test_calibrator_survives_reload(spark, table, model, method, tmp_path):
    fitted, _ = model
    raw = fitted.score(table, keep=("TransactionID", "isFraud"))
    calibrated = RiskModel(**{**fitted.__dict__, "calibrator": calibrate.FITTERS[method](raw, "raw_score", "isFraud")})
    calibrated.save(spark, str(tmp_path))
    one = calibrated.score(table).select("TransactionID", "fraud_score")
    two = RiskModel.load(spark, str(tmp_path)).score(table).select("TransactionID", F.col("fraud_score").alias("o"))
    assert one.join(two, "TransactionID").filter("abs(fraud_score - o) > 1e-12").count() == 0


def test_model_learns_and_missing_columns_are_zero(spark, table, model):
    fitted, _ = model
    assert training.evaluate_model(fitted, table).first().auc_roc > 0.8
    assert fitted.score(table.drop("c", "d")).count() == table.count()
    scores = fitted.score(table).agg(F.min("fraud_score"), F.max("fraud_score")).first()
    assert 0 <= scores[0] <= scores[1] <= 1


def test_logistic_and_smote_models(table):
    for settings in (Settings(kind="logistic", use_anomaly=False), Settings(rounds=3, depth=2, resample="smote", bottleneck=2)):
        assert training.evaluate_model(fit_model(table, NAMES, settings), table).first().auc_roc > 0.8


def recall_of(spark, x, k=5, **options):
    rows = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "TransactionID long, values array<double>")
    got = {}
    for r in nearest_neighbours(rows, k, **options).collect():
        got.setdefault(r.TransactionID, {})[r.rank] = (r.neighbour, r.distance)
    hit = 0
    for i in range(len(x)):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        d[i] = np.inf
        want = np.argsort(d, kind="stable")[:k]
        assert [got[i][n + 1][1] for n in range(k)] == pytest.approx([d[got[i][n + 1][0]] for n in range(k)])
        hit += len({got[i][n + 1][0] for n in range(k)} & set(want))
    return hit / (k * len(x))


def test_neighbours_are_exact_while_rows_fit_a_block(spark):
    assert recall_of(spark, np.random.RandomState(0).rand(60, 3)) == 1


def test_neighbours_of_many_blocks_are_nearly_all_found(spark):
    rng = np.random.RandomState(1)
    centres = rng.randn(40, 32) * 2
    assert recall_of(spark, centres[rng.randint(40, size=3000)] + rng.randn(3000, 32) * 0.5, block_rows=256) >= 0.9
    assert recall_of(spark, rng.rand(2000, 3), block_rows=100) >= 0.9


def test_neighbours_of_many_blocks_are_exact(spark, monkeypatch):
    """Also where the lines find little: no structure, many cells, and more equal rows than a search returns."""
    rng = np.random.RandomState(3)
    monkeypatch.setattr(smote_module, "PART_ROWS", 32)
    assert recall_of(spark, rng.randn(1500, 24), block_rows=50, lines=2) == 1
    whole = smote_module._within_reach
    monkeypatch.setattr(smote_module, "_within_reach", lambda vectors, found, k: whole(vectors, found, k, 200))
    assert recall_of(spark, rng.randn(1500, 24), block_rows=50, lines=2) == 1
    equal = rng.randint(3, size=(900, 3)).astype(float)
    rows = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(equal)], "TransactionID long, values array<double>")
    got = {}
    for r in nearest_neighbours(rows, block_rows=60).collect():
        got.setdefault(r.TransactionID, {})[r.rank] = r.neighbour
    for i in range(len(equal)):
        distance = ((equal - equal[i]) ** 2).sum(1)
        distance[i] = np.inf
        assert [got[i][n] for n in range(1, 6)] == np.argsort(distance, kind="stable")[:5].tolist()


def test_work_of_neighbours_is_linear(spark):
    """Each row is compared with at most two blocks on each line."""
    rows = spark.range(4000).select(F.col("id").alias("TransactionID"), F.array(F.rand(1), F.rand(2), F.rand(3)).alias("values")).cache()
    vectors = rows.toDF("id", "v")
    sent = smote_module._along_lines(smote_module._projected(vectors, 3, 1), 3, 64, 5)
    plan = sent._jdf.queryExecution().optimizedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert sent.groupBy("id").count().agg(F.max("count")).first()[0] <= 3 * 5


def test_smote_balances_and_stays_on_segments(spark):
    rng = np.random.RandomState(1)
    x = rng.rand(100, 4)
    rows = [(i, int(i < 12), [float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "TransactionID long, isFraud int, values array<double>")
    made = smote(df, block_rows=16).collect()
    assert len(made) == 100 - 12 - 12
    for r in made:
        a, b = x[r.TransactionID], x[r.neighbour]
        assert r.neighbour < 12 and r.neighbour != r.TransactionID and 0 <= r.part < 1
        assert list(r["values"]) == pytest.approx(list(a + r.part * (b - a)))
    copies = {}
    for r in made:
        copies[r.TransactionID] = copies.get(r.TransactionID, 0) + 1
    assert set(copies.values()) <= {6, 7}
    again = smote(df.repartition(7), block_rows=50).select("TransactionID", "copy", "neighbour")
    assert again.exceptAll(smote(df, block_rows=16).select("TransactionID", "copy", "neighbour")).count() == 0


def test_smote_without_minority(spark):
    df = spark.createDataFrame([(1, 0, [1.0])], "TransactionID long, isFraud int, values array<double>")
    assert smote(df).count() == 0


def score_table(spark):
    rng = random.Random(5)
    rows = [(i, y, min(0.999, max(0.001, rng.betavariate(2 + 3 * y, 4)))) for i, y in ((i, int(rng.random() < 0.3)) for i in range(800))]
    return spark.createDataFrame(rows, "TransactionID long, y int, p double")


def test_calibrators(spark):
    df = score_table(spark)
    platt = calibrate.fit_platt(df, "p")
    assert platt.slope > 0
    iso = calibrate.fit_isotonic(df, "p").transform(df, "p", "q").orderBy("p").collect()
    assert all(a.q <= b.q + 1e-12 for a, b in zip(iso, iso[1:])) and 0 <= iso[0].q and iso[-1].q <= 1
    far = spark.createDataFrame([(-5.0,), (7.0,)], "p double")
    ends = [r.q for r in calibrate.fit_isotonic(df, "p").transform(far, "p", "q").orderBy("p").collect()]
    assert ends == [iso[0].q, iso[-1].q]
    t = calibrate.fit_temperature(df, "p").temperature
    pdf = df.toPandas()

    def nll(temp):
        z = np.log(pdf.p / (1 - pdf.p)) / temp
        q = np.clip(1 / (1 + np.exp(-z)), 1e-7, 1 - 1e-7)
        return -(pdf.y * np.log(q) + (1 - pdf.y) * np.log(1 - q)).mean()

    grid = np.linspace(0.01, 10, 5000)
    assert nll(t) <= min(nll(g) for g in grid) + 1e-5


def test_calibration_keeps_ranking(spark):
    table, _ = training.calibrate_and_compare(score_table(spark), "p", "y", "platt")
    got = {r.metric: r for r in table.collect()}
    assert got["auc_roc"].delta == pytest.approx(0, abs=1e-9) and len(got) == 5


def test_temperature_one_changes_nothing(spark):
    row = spark.range(1).select(calibrate.Temperature(1.0).apply(F.lit(0.3)).alias("p")).first()
    assert row.p == pytest.approx(0.3)


# -- flows -------------------------------------------------------------------------------------


def test_prepare_uses_training_rows_only(spark, sf):
    df = views.tx_events(spark, sf)
    train, test, names, risk, cards = training.prepare(df)
    assert train.join(test, "TransactionID").count() == 0 and train.count() + test.count() == df.count()
    assert cards.agg(F.sum("card_tx_count")).first()[0] == train.count()
    assert risk.agg(F.sum("merchant_tx_count")).first()[0] == train.count()
    assert "velocity_std_24h" in names and "isFraud" not in names


def test_score_and_explain(spark, sf, tmp_path):
    df = views.tx_events(spark, sf).drop("C1")
    train, _, names, risk, cards = training.prepare(df)
    fitted = fit_model(train, names, TINY)
    scored = score_batch(df, fitted, risk, cards, threshold=0.4)
    assert scored.count() == df.count()
    assert scored.filter("anomaly_flag").count() > 0
    assert scored.filter("is_fraud <> (raw_score >= 0.4)").count() == 0
    fitted.save(spark, str(tmp_path))
    full = score_batch(df, fitted, risk, cards, threshold=0.4, model_path=str(tmp_path))
    both = full.join(scored.select("TransactionID", F.col("fraud_score").alias("f"), F.col("anomaly_score").alias("a")), "TransactionID")
    assert both.filter("abs(fraud_score - f) < 2e-6 and abs(anomaly_score - a) < 2e-6").count() == df.count()
    assert both.filter("size(top_risk_factors) = 5 and explanation like 'Transaction $%'").count() == df.count()
    rows = explain_batch(train, fitted, str(tmp_path), k=5).collect()
    direct = {r.TransactionID: r.fraud_score for r in fitted.score(train).collect()}
    assert all(r.fraud_score == pytest.approx(direct[r.TransactionID], abs=1e-9) for r in rows)
    assert len(rows) == train.count()
    for r in rows[:20]:
        sizes = [abs(f.shap_value) for f in r.factors]
        assert len(sizes) == 5 and sizes == sorted(sizes, reverse=True)
        assert r.explanation.startswith("Transaction $") and r.explanation.split()[-1] in ("BLOCK.", "REVIEW.", "MONITOR.")


def test_cross_validation_and_ablation(spark, table):
    folds = training.cross_validate(table, NAMES, Settings(kind="logistic", use_anomaly=False), k=3)
    summary = training.cross_validation_summary(folds).first()
    assert summary.folds == 3 and summary.auc_pr_mean > 0.5
    variants = ["1_logistic_baseline", "3_trees_costsensitive", "4_full_ensemble"]
    result, scores = training.ablation(table, table, NAMES, TINY, variants)
    assert [r.variant for r in result.collect()] == variants
    assert metrics.ablation_summary(result, training.SUBJECT, training.BASELINES).count() == 1
    record = reports.ablation_record(result, scores, training.SUBJECT, training.BASELINES, replicates=8).first()
    assert {r.baseline for r in record.significance} == set(variants[:2]) and len(record.variants) == 3
    assert record.interval.replicates == 8 and record.interval.ci_low <= record.interval.ci_high
    assert all(0 <= r.p_value <= 1 and r.significant == (r.p_value < 0.05) for r in record.significance)
    assert record.improvement.best_baseline_precision is not None


def test_training_and_calibration_jobs_over_files(spark, sf, tmp_path):
    raw = views.tx_events(spark, sf).select(
        "TransactionID", "TransactionDT", "TransactionAmt", "ProductCD", "card1", "addr1", "addr2", "isFraud"
    )
    raw.write.option("header", True).csv(str(tmp_path / "tx"))
    ids = raw.filter("TransactionID % 2 = 0").select("TransactionID", (F.col("TransactionAmt") * 2).alias("id_01"))
    ids.write.option("header", True).csv(str(tmp_path / "ids"))
    out = str(tmp_path / "out")
    tx_table, id_table = io.read_transactions(spark, str(tmp_path / "tx")), io.read_identity(spark, str(tmp_path / "ids"))
    row = training.run_training(tx_table, id_table, out, TINY).first()
    assert 0 <= row.auc_roc <= 1 and sum(map(sum, row.confusion_matrix)) > 0
    assert {r["class"] for r in row.classification_report} == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    curve = row.precision_recall_curve
    assert 0 < len(curve) <= 100 and [p.threshold for p in curve] == sorted(p.threshold for p in curve) and curve[0].recall == 1
    test = io.read_features(spark, f"{out}/test_features")
    assert "id_01" in test.columns and "C14" in test.columns
    got = training.run_calibration(spark, out, "isotonic")
    record = got.first()
    assert record.method == "isotonic" and record.n_rows > 0 and len(record.sweep) <= 11
    assert record.delta.f1 == pytest.approx(record.after.f1 - record.before.f1)
    assert record.distribution_before.score_min <= record.distribution_before.p50 <= record.distribution_after.score_max + 1
    again = RiskModel.load(spark, f"{out}/calibrated_model")
    assert again.score(test).filter("fraud_score between 0 and 1").count() == test.count()


def test_rounds_are_kept_up_to_the_lowest_loss_before_patience_ends():
    assert trim.best_rounds([5, 4, 3, 4, 4, 4, 1], patience=3) == 3
    assert trim.best_rounds([5, 4, 3, 4, 4, 4, 1], patience=10) == 7
    assert trim.best_rounds([5, 5, 5], patience=1) == 1


def noisy(spark, n=600):
    rng = random.Random(8)
    rows = [(i, rng.random(), rng.random(), int(rng.random() < 0.5)) for i in range(n)]
    return spark.createDataFrame(rows, "TransactionID long, a double, b double, isFraud int").cache()


def test_patience_stops_trees_that_learn_nothing(spark):
    df = noisy(spark)
    short = classify.fit_trees(df, ["a", "b"], rounds=25, depth=3, patience=4, penalty=0.0)
    long = classify.fit_trees(df, ["a", "b"], rounds=25, depth=3, validation_share=0.0, penalty=0.0)
    assert long.getNumTrees == 25 and short.getNumTrees < 12
    # The trees that stay are the first ones, unchanged.
    rows = classify.probability(df, short, ["a", "b"]).filter("probability between 0 and 1")
    assert rows.count() == df.count()


def test_first_rounds_do_not_depend_on_how_many_follow(spark):
    df = noisy(spark, 300)
    few, many = (classify.fit_trees(df, ["a", "b"], rounds=n, depth=2, validation_share=0.0, penalty=0.0) for n in (3, 6))
    cut = trim.trimmed(spark, many, 3, 0.0)
    a, b = (sorted((r.TransactionID, r.probability) for r in classify.probability(df, m, ["a", "b"]).collect()) for m in (few, cut))
    assert a == b


def test_a_model_keeps_its_scores_when_nothing_is_cut(spark):
    df = noisy(spark, 300)
    model = classify.fit_trees(df, ["a", "b"], rounds=3, depth=3, validation_share=0.0, penalty=0.0)
    again = trim.trimmed(spark, model, 3, 0.0)
    a, b = (sorted((r.TransactionID, r.probability) for r in classify.probability(df, m, ["a", "b"]).collect()) for m in (model, again))
    assert a == b
    two = trim.trimmed(spark, model, 2, 0.0)
    assert two.getNumTrees == 2 and list(two.treeWeights) == list(model.treeWeights)[:2]


def test_the_penalty_prunes_splits_that_save_little(spark):
    df = noisy(spark)
    sizes = [classify.fit_trees(df, ["a", "b"], rounds=4, depth=4, validation_share=0.0, penalty=p).totalNumNodes for p in (0.0, 5.0, 1e9)]
    assert sizes[0] > sizes[1] > sizes[2] == 4
    clear = spark.createDataFrame([(i, i / 400, int(i >= 200)) for i in range(400)], "TransactionID long, a double, isFraud int")
    assert classify.fit_trees(clear, ["a"], rounds=1, depth=3, validation_share=0.0, penalty=5.0).totalNumNodes == 3


def test_explanations_of_a_logistic_model_add_up(spark, table, tmp_path):
    model = fit_model(table, NAMES, Settings(kind="logistic", use_anomaly=False))
    model.save(spark, str(tmp_path))
    rows = explain_batch(table, model, str(tmp_path), k=3).collect()
    direct = {r.TransactionID: r.fraud_score for r in model.score(table).collect()}
    assert all(r.fraud_score == pytest.approx(direct[r.TransactionID], abs=1e-9) and len(r.factors) == 3 for r in rows)


# -- explanations ------------------------------------------------------------------------------


def explained(spark, score, factors, **columns):
    rows = ", ".join(f"named_struct('feature', '{f}', 'shap_value', {v}D)" for f, v in factors)
    df = spark.range(1).select(F.lit(score).alias("s"), F.lit(120.5).alias("amt"), F.expr(f"array({rows})").alias("c"),
                               *[F.lit(v).alias(k) for k, v in columns.items()])
    top = attribution.top_factors(F.col("c"), 10)
    return df.select(attribution.rule_explanation(df.columns, top, F.col("s"), F.col("amt")).alias("t"), top.alias("f")).first()


@pytest.mark.parametrize("score,action", [(0.8, "REVIEW"), (0.81, "BLOCK"), (0.5, "MONITOR"), (0.51, "REVIEW")])
def test_action_bands(spark, score, action):
    assert explained(spark, score, [("x", 0.1)]).t.endswith(f"Recommended action: {action}.")


def test_reasons(spark):
    row = explained(spark, 0.9, [("tx_is_night", 0.1), ("velocity_count_1h", 0.5), ("C1", -0.9), ("C2", 0.2)], velocity_count_1h=4)
    assert row.t == (
        "Transaction $120.50 flagged with 90.0% fraud probability. Key indicators: "
        "High transaction velocity (4 transactions in last hour); Elevated C2 risk factor. Recommended action: BLOCK."
    )
    assert [f.direction for f in row.f] == ["decreases_fraud_risk"] + ["increases_fraud_risk"] * 3
    assert "Multiple risk factors detected" in explained(spark, 0.1, [("x", -1.0)]).t


def test_equal_factors_are_ordered_by_name(spark):
    row = explained(spark, 0.1, [("z", 0.5), ("b", -0.5), ("a", 0.5)])
    assert [f.feature for f in row.f] == ["a", "b", "z"]


def test_prompt(spark):
    df = spark.sql("select array(named_struct('feature','amt_zscore','shap_value',0.25D,'direction','i')) f")
    text = df.select(attribution.analyst_prompt(
        F.col("f"), F.lit(0.912), F.lit(0.2), F.lit(0.05),
        {"id": F.lit(7), "amount": F.lit(3.5), "product": F.lit(None).cast("string"), "card": F.lit(123456)},
    )).first()[0]
    assert "- Card: ending in 3456" in text and "- Amount: $3.50" in text and "Category: Unknown" in text
    assert "  1. amt_zscore: ↑ increases fraud risk (SHAP=+0.2500)" in text and "Score: 91.2%" in text


def test_fixed_text_is_rounded_by_the_exact_value(spark):
    values = [0.25 / 5000, -0.25 / 5000, 0.125, 2.5, -0.5, 1.5, 0.00015, 123456789.00005, 64.03875, 0.0, -1e-9]
    values += [(2 * n + 1) * 5 / 10**k for n in range(0, 4000, 7) for k in range(2, 7)]
    df = spark.createDataFrame([(float(x),) for x in values], "x double")
    for digits in (0, 1, 2, 4):
        rows = df.select("x", fixed(F.col("x"), digits).alias("plain"), fixed(F.col("x"), digits, plus=True).alias("signed")).collect()
        assert [(r.plain, r.signed) for r in rows] == [(f"{r.x:.{digits}f}", f"{r.x:+.{digits}f}") for r in rows]


def test_blocks_are_compared_in_slices():
    """A row's neighbours in a block are those of the whole block, and no matrix is larger than a slice of it."""
    import tracemalloc

    rng = np.random.default_rng(4)
    b, ids = rng.random((4096, 64)), np.arange(4096)
    squares, own = (b * b).sum(1), 2048
    tracemalloc.start()
    parts = [smote_module.nearest(ids[k : k + smote_module.TOGETHER], b[k : k + smote_module.TOGETHER], ids, b, squares, 5) for k in range(0, own, smote_module.TOGETHER)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6
    for at in (0, 255, 256, 2047):
        got = [p[p["id"] == at]["neighbour"].tolist() for p in parts if (p["id"] == at).any()]
        distance = ((b - b[at]) ** 2).sum(1)
        distance[at] = np.inf
        assert got == [np.argsort(distance, kind="stable")[:5].tolist()]


def test_smallest_values_of_a_row():
    """Ties, missing values and short rows are treated as by a full sort."""
    rng = np.random.default_rng(5)
    equal = np.ones((3, 4000))
    for values in (rng.random((50, 4096)), rng.integers(0, 9, (20, 3001)).astype(float), rng.random((4, 200)), equal, np.where(rng.random((9, 3500)) < 0.9, np.nan, 1.0)):
        got = np.take_along_axis(values, smote_module.smallest(values, 13), 1)
        np.testing.assert_array_equal(np.sort(got, 1), np.sort(values, 1)[:, :13])
    assert set(smote_module.smallest(equal, 13)[0]) == set(range(13))


def test_variants_and_folds_are_fitted_at_once(spark, table, monkeypatch):
    """Fits meet in threads of their own, and the order and values of the results don't depend on that."""
    import threading

    meeting = threading.Barrier(3, timeout=60)

    def fit(*args, **kwargs):
        meeting.wait()
        return fit_model(*args, **kwargs)

    monkeypatch.setattr(training, "fit_model", fit)
    plain = Settings(kind="logistic", use_anomaly=False)
    folds = training.cross_validate(table, NAMES, plain, k=3).collect()
    assert [r.fold for r in folds] == [0, 1, 2] and len({r.auc_pr for r in folds}) == 3
    variants = ["3_trees_costsensitive", "1_logistic_baseline", "8_no_smote"]
    result, scores = training.ablation(table, table, NAMES, TINY, variants)
    assert [r.variant for r in result.collect()] == variants == list(scores)


def test_refits_do_not_stop_just_short_of_the_end(spark, table, monkeypatch):
    """All rounds are run when patience doesn't end, without a refit that is nearly as long."""
    runs = []
    fit = classify.GBTClassifier.fit
    monkeypatch.setattr(classify.GBTClassifier, "fit", lambda self, rows: runs.append(self.getMaxIter()) or fit(self, rows))
    monkeypatch.setattr(classify, "best_rounds", lambda losses, patience: len(losses))
    model = classify.fit_trees(table, ["a", "b"], rounds=9, depth=2, patience=1)
    assert runs == [2, 4, 9] and len(model.trees) == 9
    runs, run = [60], 60
    while run < 500:
        run = classify.next_rounds(run, 500)
        runs.append(run)
    assert runs == [60, 120, 240, 500]


def nodes_of(model):
    """Feature, threshold, gain, prediction and cover of all nodes, by tree, and the weights of the trees."""
    out = []
    for tree in model._call_java("trees"):
        open_, found = [tree.rootNode()], []
        while open_:
            node = open_.pop()
            found.append([node.prediction(), node.impurity(), float(node.impurityStats().count())])
            if node.subtreeDepth():
                split = node.split()
                found[-1] += [split.featureIndex(), split.threshold(), node.gain()]
                open_ += [node.leftChild(), node.rightChild()]
        out.append(found)
    return out, list(model.treeWeights)


@pytest.mark.parametrize("weight", [None, 1.0])
def test_large_tables_get_the_trees_of_spark(spark, monkeypatch, weight):
    """With the same rounds kept, the same draws of rows and features, and the same bins."""
    rng, names = np.random.RandomState(6), ["a", "b", "c", "d", "e"]
    x = rng.randn(5000, 5).round(3)
    x[:, 3] = rng.randint(4, size=5000)
    x[:, 4] = np.where(rng.rand(5000) < 0.5, 0, x[:, 4])
    y = (x[:, 0] + x[:, 1] * x[:, 3] / 2 + rng.randn(5000) > 1).astype(int)
    rows = spark.createDataFrame([(i, *map(float, r), int(v)) for i, (r, v) in enumerate(zip(x, y))], "TransactionID long, a double, b double, c double, d double, e double, isFraud int")
    rows = rows.coalesce(1).cache()
    options = dict(rounds=40, depth=4, step=0.3, patience=3, penalty=0.5, positive_weight=weight)
    want = classify.fit_trees(rows, names, **options)
    monkeypatch.setattr(classify, "SPARK_ROWS", 0)
    got = classify.fit_trees(rows, names, **options)
    assert 3 < got.getNumTrees < 40 and got.numFeatures == 5
    (a, wa), (b, wb) = nodes_of(want), nodes_of(got)
    assert wa == wb and [len(t) for t in a] == [len(t) for t in b]
    for s, t in zip(a, b):
        for m, n in zip(s, t):
            assert m == pytest.approx(n, rel=1e-6, abs=1e-9)


def test_boosting_does_not_depend_on_blocks(spark, monkeypatch):
    """Blocks of a few rows give the draws of whole partitions, and all rounds are run when patience doesn't end."""
    from riskspark.ml import boost

    rng = np.random.RandomState(7)
    x = rng.rand(900, 2)
    rows = spark.createDataFrame([(i, float(a), float(b), int(a > b)) for i, (a, b) in enumerate(x)], "TransactionID long, a double, b double, isFraud int")
    rows = rows.repartition(3).cache()
    monkeypatch.setattr(classify, "SPARK_ROWS", 0)
    whole = classify.fit_trees(rows, ["a", "b"], rounds=12, depth=3, patience=12, penalty=0.0)
    monkeypatch.setattr(boost, "BLOCK_ROWS", 50)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    try:
        small = classify.fit_trees(rows, ["a", "b"], rounds=12, depth=3, patience=12, penalty=0.0)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert whole.getNumTrees == small.getNumTrees == 12
    a, b = (sorted((r.TransactionID, r.probability) for r in classify.probability(rows, m, ["a", "b"]).collect()) for m in (whole, small))
    assert [p for _, p in a] == pytest.approx([p for _, p in b], abs=1e-9)
