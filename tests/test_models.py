import math
import os
import pickle

import numpy as np
import pytest
from pyspark import RDD
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from verisift.models import accrual, boosting, deduction, leakage, metrics, returns, tracking
from verisift.models.training import numeric_features, quality_weight
from verisift.plans.jobs import accrual_job, feature_job, training_table
from verisift.plans import bindings as b, queries
from verisift.plans.queries import QUERIES
from verisift.session import ensure_checkpoint_dir

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def planted(spark):
    x = (F.xxhash64("id", F.lit(1)) % 1000) / 1000.0
    y = (F.xxhash64("id", F.lit(2)) % 1000) / 1000.0
    df = spark.range(1500).select("id", x.alias("x"), y.alias("y"))
    return df.withColumns(
        {
            "accrual_amount": 10 * F.col("x") + F.col("y"),
            "is_returned": F.col("x") + 0.1 * F.col("y") > 0.6,
            "dq_score": F.lit(80.0),
        }
    ).repartition(4).cache()


def test_accrual_training_and_scoring(planted):
    params = {"maxIter": 8, "maxDepth": 4}
    trained = accrual.train(planted, ["x", "y"], params=params, folds=2)
    assert set(trained.metrics) == {"cv_mae_mean", "cv_mae_std"}
    scored = accrual.score(trained.model, planted, model_version="1", correlation_id="c")
    assert "_features" not in scored.columns
    assert scored.first()["_audit_pipeline_name"] == "accrual_forecast_batch"
    found = metrics.regression_metrics(scored, "accrual_amount", "predicted_accrual").first()
    assert found["r2"] > 0.95 and found["mae"] < 0.6
    assert accrual.DEFAULTS == {"maxIter": 200, "maxDepth": 6, "stepSize": 0.1, "subsamplingRate": 0.8}


def test_returns_training_and_scoring(planted):
    trained = returns.train(planted, ["x", "y"], params={"numTrees": 10, "maxDepth": 5}, folds=2)
    assert trained.metrics["cv_auc_mean"] > 0.95
    scored = returns.score(trained.model, planted, model_version="1")
    found = metrics.returns_metrics(scored, "is_returned", "predicted_return", "return_probability").first()
    assert found["auc_roc"] > 0.97 and found["f1"] > 0.9
    with pytest.raises(ValueError, match="both classes"):
        returns.train(planted.where("is_returned"), ["x", "y"])


def test_text_training_and_scoring(spark):
    documents = b.table(spark, SF, "documents").select(
        F.col("text").alias("remittance_text"), F.col("lang").alias("deduction_type")
    )
    trained = deduction.train(documents, params={"max_iter": 15}, folds=2)
    assert trained.metrics["num_classes"] == 4 and trained.metrics["cv_f1_macro_mean"] > 0.5
    scored = deduction.score(trained.model, documents, model_version="1")
    pairs = metrics.confusion(scored, "deduction_type", "predicted_deduction_type")
    assert metrics.class_metrics(pairs).first()["accuracy"] > 0.9
    text = documents.first()["remittance_text"]
    single = deduction.score_text(spark, trained.model, text, model_version="1").first()
    assert single["type"] in {"en", "de", "fr", "es"} and 0.25 <= single["confidence"] <= 1
    assert deduction.score_text(spark, trained.model, None, model_version="1").count() == 1


@pytest.mark.parametrize(
    ("name", "module", "size"),
    [
        ("text_model", deduction, {"maxIter": 500}),
        ("returns_model", returns, {"numTrees": 300, "maxDepth": 8, "minInstancesPerNode": 5}),
    ],
)
def test_registered_models_have_the_default_size(spark, monkeypatch, name, module, size):
    class Reached(Exception):
        pass

    def fit(stages, df, evaluator, *, folds):
        found = {p.name: v for p, v in stages[-1].extractParamMap().items()}
        assert folds == 5 and {k: found[k] for k in size} == size
        raise Reached

    monkeypatch.setattr(module, "fit", fit)
    with pytest.raises(Reached):
        QUERIES[name](spark, SF)


def test_registered_forecast_has_the_default_size(spark, monkeypatch):
    class Reached(Exception):
        pass

    def boost(df, feature_cols, **size):
        assert size == {"trees": 200, "depth": 6, "rate": 0.1, "subsample": 0.8, "folds": 5}
        raise Reached

    monkeypatch.setattr(accrual, "boost", boost)
    with pytest.raises(Reached):
        QUERIES["accrual_model"](spark, SF)


def _boosted_by_hand(x, y, w, fold, hashes, edges, grids, *, trees, depth, rate, subsample, out):
    """Plain recursive boosting over the same bins, folds and draws."""
    bins = np.array([np.where(np.isnan(c), 0, np.searchsorted(e, c, side="left") + 1) for c, e in zip(x.T, edges)]).T
    part = fold != out
    heavy = np.rint(w * grids[1]) / grids[1]
    base = (heavy * y)[part].sum() / heavy[part].sum()
    found = np.full(len(y), base)

    def gain(g, h):
        return g.sum() ** 2 / h.sum() if h.sum() > 0 else 0.0

    for tree in range(trees):
        draw = boosting._mixed(hashes + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 % 2**64)) < np.uint64(int(subsample * 2**64))
        step = np.zeros(len(y))

        def grow(rows, level):
            used = rows & part & draw
            g, h = np.rint(w * (y - found) * grids[0])[used] / grids[0], heavy[used]
            best, at = 1e-12 * max(gain(g, h), 1e-300), None
            if level < depth and h.sum() > 0:
                for f in range(bins.shape[1]):
                    for cut in range(boosting.BINS + 1):
                        left = bins[used, f] <= cut
                        if left.any() and not left.all():
                            won = gain(g[left], h[left]) + gain(g[~left], h[~left]) - gain(g, h)
                            if won > best * (1 + 1e-9):
                                best, at = won, (f, cut)
            if at is None:
                step[rows] = (rate if tree else 1.0) * (g.sum() / h.sum() if h.sum() > 0 else 0.0)
                return
            left = bins[:, at[0]] <= at[1]
            grow(rows & left, level + 1)
            grow(rows & ~left, level + 1)

        grow(np.ones(len(y), bool), 0)
        found = found + step
    return found


def test_boosting_equals_a_plain_version(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(160, 3)), 1)
    x[::17, 1] = np.nan
    y = np.round(3 * x[:, 0] - np.nan_to_num(x[:, 1], nan=4.0) ** 2 + rng.normal(size=160), 3)
    w = rng.integers(1, 5, 160) / 4
    rows = [(*map(float, a), float(b), float(c)) for a, b, c in zip(x, y, w)] + [(0.5, 0.5, 0.5, 1.0, 1.0)] * 40
    df = spark.createDataFrame(rows, "a double, b double, c double, _label double, _weight double")
    size = {"trees": 6, "depth": 3, "rate": 0.3, "subsample": 0.8}
    seen = {}
    blocks_of = boosting._blocks

    def kept(data, cols, edges, parts, folds):
        made = blocks_of(data, cols, edges, parts, folds)
        seen.update(edges=edges, blocks=made.collect(), parts=made.getNumPartitions())
        return made

    monkeypatch.setattr(boosting, "_blocks", kept)
    model, errors = boosting.boost(df, ["a", "b", "c"], **size, folds=4)
    bins, label, weight, hashes, fold = (np.concatenate([b[i] for b in seen["blocks"]], axis=-1) for i in range(5))
    assert len(label) == 200 and len(np.unique(hashes)) == 200 and set(fold) == {0, 1, 2, 3}
    spread = max(label.max() - label.min(), abs(label.max()), abs(label.min()))
    grids = (boosting._grid(4.0 * spread * weight.sum()), boosting._grid(2.0 * weight.sum()))
    # any value inside a bin stands for it
    edges = [np.arange(1, boosting.BINS) + 0.5] * 3
    values = np.where(bins == 0, np.nan, bins.astype(float)).T
    mine = [_boosted_by_hand(values, label, weight, fold, hashes, edges, grids, **size, out=m) for m in range(5)]
    for m in range(4):
        held = fold == m
        assert errors[m] == pytest.approx(np.average(np.abs(label - mine[m])[held], weights=weight[held]), rel=1e-9)
    scored = boosting.with_prediction(model, df, "p").collect()
    np.testing.assert_allclose(sorted(r["p"] for r in scored), sorted(mine[4]), rtol=1e-9)
    # the same by levels over many partitions, whatever the partitions of the input
    monkeypatch.setattr(boosting, "PARTITION_ROWS", 30)
    monkeypatch.setattr(boosting, "CHECKPOINT_TREES", 2)
    again, errors_again = boosting.boost(df.repartition(5), ["a", "b", "c"], **size, folds=4)
    assert seen["parts"] == 7 and errors_again == pytest.approx(errors, rel=1e-12)
    for name in ("feature", "cut", "value"):
        assert np.array_equal(getattr(again, name), getattr(model, name))


def test_only_splits_reach_the_driver(spark, monkeypatch):
    rows = [(float(i), float(i % 7), 1.0) for i in range(400)]
    df = spark.createDataFrame(rows, "a double, _label double, _weight double").repartition(4)
    collected, collect = [], RDD.collect

    def watched(rdd):
        collected.append(collect(rdd))
        return collected[-1]

    monkeypatch.setattr(boosting, "PARTITION_ROWS", 100)
    monkeypatch.setattr(RDD, "collect", watched)
    model, errors = boosting.boost(df, ["a"], trees=2, depth=4, rate=0.5, subsample=1.0, folds=3)
    assert len(errors) == 3 and model.feature.shape == (2, 15)
    assert collected and max(len(pickle.dumps(c)) for c in collected) < 8_000


def test_forecast_leaves_no_joins_checkpoints_and_shuffles(spark, monkeypatch):
    """The training rows are computed once, and old states of a training do not stay on the disk."""
    training = queries._accrual_training(spark, SF)
    assert "Exchange" not in training._jdf.queryExecution().executedPlan().toString()
    rows = [(float(i), float(i % 7), 1.0) for i in range(400)]
    df = spark.createDataFrame(rows, "a double, _label double, _weight double").repartition(4)
    monkeypatch.setattr(boosting, "PARTITION_ROWS", 100)
    monkeypatch.setattr(boosting, "CHECKPOINT_TREES", 1)
    ensure_checkpoint_dir(spark)
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before, forgotten, forget = set(os.listdir(folder)), [], boosting.forget_shuffles
    monkeypatch.setattr(boosting, "forget_shuffles", lambda rdd: forgotten.append(forget(rdd)))
    boosting.boost(df, ["a"], trees=4, depth=2, rate=0.5, subsample=1.0, folds=3)
    assert len(set(os.listdir(folder)) - before) == 1  # the training rows
    assert len(forgotten) == 1 + 4 * 2


def test_boosting_of_few_rows_and_gaps(spark):
    kind = "a double, _label double, _weight double"
    size = {"trees": 3, "depth": 2, "rate": 1.0, "subsample": 1.0, "folds": 1}
    one = spark.createDataFrame([(1.0, 5.0, 1.0), (None, None, 1.0), (2.0, 9.0, 0.0)], kind)
    model, errors = boosting.boost(one, ["a"], **size)
    assert errors == [] and [r["p"] for r in boosting.with_prediction(model, one, "p").collect()] == [5.0, 5.0, 5.0]
    gaps = spark.createDataFrame([(None, 1.0, 1.0), (float("nan"), 1.0, 1.0), (3.0, 2.0, 1.0), (4.0, 2.0, 1.0)], kind)
    model, _ = boosting.boost(gaps, ["a"], **size)
    assert [r["p"] for r in boosting.with_prediction(model, gaps, "p").collect()] == pytest.approx([1.0, 1.0, 2.0, 2.0])
    with pytest.raises(ValueError, match="needs rows"):
        boosting.boost(one.limit(0), ["a"], **size)


def test_smooth_idf_weights(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(Vectors.dense([1, 0]),), (Vectors.dense([1, 1]),)], ["v"])
    weights = deduction.SmoothIdf(inputCol="v", outputCol="w").fit(df).getScalingVec()
    assert list(weights) == pytest.approx([np.log(3 / 3) + 1, np.log(3 / 2) + 1])


def test_leakage_finds_planted_anomalies(spark):
    usual = spark.range(2000).select(
        "id", F.randn(1).alias("a"), F.randn(2).alias("b")
    )
    strange = spark.range(20).select((F.col("id") + 5000).alias("id"), F.lit(9.0).alias("a"), (F.col("id") * 0.1 - 9).alias("b"))
    df = usual.unionByName(strange).cache()
    forest = leakage.train(df, ["a", "b"])
    assert len(forest.trees) == 200 and forest.sample_size == 256
    assert forest.metrics["anomaly_rate"] == pytest.approx(0.05, abs=0.01)
    assert forest.metrics["training_samples"] == 2020
    scored = leakage.score(forest, df, model_version="1").cache()
    assert scored.where("id >= 5000 and is_leakage").count() == 20
    found = metrics.auc(scored.select((F.col("id") >= 5000).alias("y"), (-F.col("anomaly_score")).alias("s")), "y", "s").first()
    assert found["auc_roc"] > 0.99
    again = leakage.train(df, ["a", "b"])
    assert again.offset == forest.offset
    gap = spark.createDataFrame([(1, None, 0.0)], "id int, a double, b double")
    row = leakage.score(forest, gap, model_version="1").first()
    assert row["anomaly_score"] is None and row["is_leakage"] is False


def test_trees_draw_from_the_whole_table(spark):
    usual = spark.range(60_000).select((F.xxhash64("id") % 1_000_000).cast("double").alias("a"), (F.col("id") * 1.0).alias("b"))
    drawn, size = leakage._samples(usual, ["a", "b"], 60_000, leakage.DEFAULTS)
    assert size == 256 and drawn.select("_features").distinct().count() > 50_000
    assert drawn.groupBy("tree").count().agg(F.count(F.lit(1)), F.min("count") >= 256, F.max("count") < 600).first() == (200, True, True)
    copies = usual.limit(6000).unionByName(spark.range(54_000).select(F.lit(0.5).alias("a"), F.lit(0.5).alias("b")))
    drawn, _ = leakage._samples(copies, ["a", "b"], 60_000, leakage.DEFAULTS)
    shares = drawn.groupBy("tree").agg(F.avg((F.col("_features")[0] == 0.5).cast("double")).alias("s"))
    assert shares.agg(F.min("s") > 0.8, F.max("s") < 0.97).first() == (True, True)


def test_forest_does_not_depend_on_partitions(spark):
    df = spark.range(3000).select((F.xxhash64("id") % 1000).cast("double").alias("a"), (F.col("id") % 7 * 1.0).alias("b")).cache()
    one, many = (leakage.train(part, ["a", "b"], params={"n_trees": 20}) for part in (df.coalesce(1), df.repartition(16)))
    assert one.offset == many.offset and len(one.trees) == len(many.trees) == 20
    for x, y in zip(one.trees, many.trees):
        assert all(np.array_equal(x[k], y[k]) for k in x)


def test_isolation_depth_of_one_tree():
    rows = np.array([[0.0], [1.0], [2.0], [10.0]])
    nodes = leakage._grow(rows, np.random.default_rng(1), 8)
    tree = leakage._packed(nodes)
    depth = leakage._depth(rows, [tree], 8)
    assert depth.min() == depth[3] or depth[3] <= 2
    assert leakage.mean_path(1) == 0 and leakage.mean_path(2) == 1
    assert leakage.mean_path(256) == pytest.approx(10.2448, abs=1e-3)


def test_auc_equals_pair_counting(spark):
    rng = np.random.default_rng(7)
    labels = rng.integers(0, 2, 300)
    scores = np.round(rng.random(300), 2)
    df = spark.createDataFrame(list(zip(labels.tolist(), scores.tolist())), "y int, s double")
    positive, negative = scores[labels == 1], scores[labels == 0]
    wins = (positive[:, None] > negative[None, :]).mean() + 0.5 * (positive[:, None] == negative[None, :]).mean()
    assert metrics.auc(df, "y", "s").first()["auc_roc"] == pytest.approx(wins)
    assert metrics.auc(df.where("y = 1"), "y", "s").first()["auc_roc"] is None


def test_metrics_of_nothing(spark):
    empty = spark.createDataFrame([], "is_leakage boolean, claim_amount double")
    row = metrics.leakage_metrics(empty).first()
    assert (row["total_flagged"], row["leakage_rate"], row["estimated_leakage_amount"]) == (0, 0.0, 0.0)


def test_quality_weight_and_feature_choice(spark, planted):
    assert planted.select(quality_weight(planted)).first()[0] == 0.8
    assert spark.range(1).select(quality_weight(spark.range(1))).first()[0] == 1.0
    assert numeric_features(planted, exclude=["id", "accrual_amount"]) == ["x", "y", "dq_score"]


def test_tracking(spark, layout):
    run = tracking.record_run(spark, layout, model_name="m", use_case="u", metrics={"mae": 1}, params={"k": 2}, tags={"t": "x"}, data_quality=90.0)
    tracking.record_run(spark, layout, model_name="m", use_case="u", metrics={"mae": 2})
    tracking.promote(spark, layout, run, "production")
    runs = spark.read.parquet(layout.catalog("model_runs"))
    stages = {r["stage"]: r["metrics"]["mae"] for r in tracking.model_stages(runs).collect()}
    assert stages == {"experimental": 2.0, "production": 1.0}
    assert runs.first()["tags"]["model_name"] == "m"
    with pytest.raises(ValueError, match="stage"):
        tracking.promote(spark, layout, run, "retired")
    tracking.record_card(spark, layout, tracking.ModelCard("m", "d", "u", "t", metrics={"mae": 1}, parameters={"k": 2}))
    card = spark.read.parquet(layout.catalog("model_cards")).first()
    assert card["version"] == "0.0.0" and card["parameters"] == {"k": "2"} and card["limitations"] == ""


def test_every_model_trains_scores_and_publishes(spark, layout, planted):
    from verisift.plans.jobs import deduction_job, leakage_job, returns_job

    small = {"numTrees": 3, "maxDepth": 3}
    returns_job(planted, planted.drop("dq_score"), ["x", "y"], layout, model_version="1", params=small, folds=1)
    leakage_job(planted, planted, ["x", "y"], layout, model_version="1", params={"n_trees": 5})
    texts = b.table(spark, SF, "documents").limit(60).select(
        F.col("text").alias("remittance_text"), F.col("lang").alias("deduction_type")
    )
    deduction_job(texts, texts, layout, model_version="1", params={"max_iter": 2, "max_features": 50}, folds=1)
    for table, column, rows in (
        ("returns_scores", "return_probability", 1500),
        ("leakage_scores", "anomaly_score", 1500),
        ("deduction_scores", "prediction_confidence", 60),
    ):
        scores = spark.read.parquet(layout.gold(table))
        assert scores.where(F.col(column).isNotNull()).count() == rows
        assert scores.select("_audit_model_version").distinct().collect()[0][0] == "1"
    runs = spark.read.parquet(layout.catalog("model_runs"))
    assert {r["use_case"] for r in runs.collect()} == {"returns_prediction", "leakage_detection", "deduction_classification"}


def test_the_penalty_follows_the_rows_of_each_fit(spark, monkeypatch):
    seen = []
    fit = LogisticRegression._fit

    def watched(self, dataset):
        seen.append((self.getRegParam(), dataset.count()))
        return fit(self, dataset)

    monkeypatch.setattr(LogisticRegression, "_fit", watched)
    texts = spark.range(60).select(
        F.when(F.col("id") % 2 == 0, "red blue").otherwise("green grey").alias("remittance_text"),
        (F.col("id") % 2).cast("string").alias("deduction_type"),
    )
    deduction.train(texts, params={"max_iter": 2, "C": 0.5}, folds=2)
    assert len(seen) == 3 and all(penalty == pytest.approx(2.0 / rows) for penalty, rows in seen)
    assert max(rows for _, rows in seen) == 60 > min(rows for _, rows in seen)


def test_features_to_published_scores(spark, layout):
    entities = {
        "transaction": b.transactions(spark, SF, "transaction_id", "customer_id", "distributor_id", "product_id", "transaction_date", "gross_amount", "product_category"),
        "contract": b.contracts(spark, SF),
        "rebate_accrual": b.accruals(spark, SF),
        "chargeback": b.chargebacks(spark, SF),
    }
    written = feature_job(entities, layout)
    assert len(written) == 14 and set(written.values()) == {1}
    assert feature_job(entities, layout, domain="seasonal_market") == {"seasonal_market/seasonal_index": 2, "seasonal_market/yoy_growth": 2}
    table = training_table(
        spark, layout, [("customer_behavior", "purchase_velocity"), ("rebate_dynamics", "rebate_velocity")], "customer_id"
    )
    features = ["purchase_velocity_30d", "purchase_velocity_90d"]
    training = table.select("customer_id", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features], F.col("rebate_velocity_12m").alias("accrual_amount"))
    accrual_job(training, training, features, layout, model_version="7", params={"maxIter": 2, "maxDepth": 2}, folds=1)
    scores = spark.read.parquet(layout.gold("accrual_scores"))
    assert scores.count() == training.count()
    assert {r["_audit_model_version"] for r in scores.select("_audit_model_version").distinct().collect()} == {"7"}
    stored = boosting.BoostedTrees.load(spark, layout.gold("models/accrual_forecast/7"))
    again = accrual.score(stored, training, model_version="7").select("customer_id", "predicted_accrual")
    assert again.exceptAll(scores.select("customer_id", "predicted_accrual")).isEmpty() and stored.feature.shape == (2, 3)


def test_folds_are_fitted_at_the_same_time_and_drawn_as_ever(spark):
    import threading

    from pyspark.ml import Estimator, Pipeline
    from pyspark.ml.evaluation import Evaluator
    from pyspark.ml.feature import SQLTransformer
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    from verisift.models import training

    together = threading.Barrier(4, timeout=60)

    class Meeting(Estimator):
        meets = True

        def _fit(self, dataset):
            if self.meets:
                together.wait()
            return SQLTransformer(statement="SELECT * FROM __THIS__")

    class Total(Evaluator):
        def _evaluate(self, dataset):
            return float(dataset.agg(F.sum("id")).first()[0])

    df = spark.range(0, 1000, 1, 3)
    _, mean, deviation = training.fit([Meeting()], df, Total(), folds=3)
    Meeting.meets = False
    alone = CrossValidator(
        estimator=Pipeline(stages=[Meeting()]), estimatorParamMaps=ParamGridBuilder().build(),
        evaluator=Total(), numFolds=3, seed=training.SEED,
    ).fit(training._stored(df))
    assert (mean, deviation) == (pytest.approx(alone.avgMetrics[0]), pytest.approx(alone.stdMetrics[0]))


def test_iterations_over_few_texts_take_few_tasks(spark, monkeypatch):
    seen = []
    fit = LogisticRegression._fit
    monkeypatch.setattr(LogisticRegression, "_fit", lambda self, d: (seen.append(d.rdd.getNumPartitions()), fit(self, d))[1])
    texts = spark.range(0, 90, 1, 6).select(
        F.when(F.col("id") % 2 == 0, "red blue").otherwise("green grey").alias("remittance_text"),
        (F.col("id") % 2).cast("string").alias("deduction_type"),
    )
    deduction.train(texts, params={"max_iter": 2}, folds=1)
    monkeypatch.setattr(deduction, "TASK_ROWS", 30)
    deduction.train(texts, params={"max_iter": 2}, folds=1)
    assert seen == [1, 3]


def test_forest_folds_equal_rows_and_ignores_partitions(spark, planted, monkeypatch, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import RandomForestClassifier

    from verisift.models import forest
    from verisift.models.training import assembler

    monkeypatch.setattr(forest, "BLOCK_ROWS", 100)
    monkeypatch.setattr(forest, "PARTITION_ROWS", 200)
    df = planted.select(F.floor(10 * F.col("x")).alias("x"), "y", F.col("is_returned").cast("double").alias("label"))
    df = df.union(df.limit(500)).withColumn("weight", 1 + F.col("label")).cache()
    vectors = assembler(["x", "y"]).transform(df)
    size = {"numTrees": 20, "maxDepth": 4, "minInstancesPerNode": 5, "seed": 7}
    shape = {"featuresCol": "_features", "weightCol": "weight"}
    model = forest.Forest(**size, **shape).fit(vectors)
    again = forest.Forest(**size, **shape).fit(vectors.repartition(7))
    assert [model.getOrDefault(p) for p in ("feature", "cut", "leaf")] == [again.getOrDefault(p) for p in ("feature", "cut", "leaf")]
    # as good as MLlib's forest, and sure of the same rows
    theirs = RandomForestClassifier(**size, **shape).fit(vectors).copy()
    right = [m.transform(vectors).where("prediction = label").count() / df.count() for m in (model, theirs)]
    assert right[0] > 0.9 and right[0] > right[1] - 0.03
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m")).transform(vectors)
    assert loaded.exceptAll(model.transform(vectors)).isEmpty()
    with pytest.raises(Exception, match="labels must not be NULL"):
        forest.Forest(**size, **shape).fit(vectors.withColumn("label", F.lit(None).cast("double")))


def test_forest_of_many_bins_and_of_no_splits(spark):
    from verisift.models import forest
    from verisift.models.training import assembler

    df = spark.range(600).select(F.col("id").cast("double").alias("x"), (F.col("id") >= 450).cast("double").alias("label"))
    vectors = assembler(["x"]).transform(df)
    model = forest.Forest(featuresCol="_features", numTrees=5, maxBins=500, maxDepth=2).fit(vectors)
    assert model.transform(vectors).where("prediction = label").count() >= 595
    flat = forest.Forest(featuresCol="_features", numTrees=5, maxDepth=0).fit(vectors).transform(vectors)
    shares = [r[0][1] for r in flat.select("probability").distinct().collect()]
    assert len(shares) == 1 and shares[0] == pytest.approx(0.25, abs=0.05)


def test_forest_by_whole_trees_and_by_combinations_of_bins(spark, planted, monkeypatch):
    """Trees grown in one task equal those grown level by level, and looking bins up equals walking the trees."""
    from verisift.models import forest
    from verisift.models.training import assembler

    monkeypatch.setattr(forest, "BLOCK_ROWS", 100)
    weight = F.when(F.col("id") % 3 == 0, 0.25).otherwise(1 + F.col("x"))
    df = planted.select(
        "x", F.floor(10 * F.col("y")).cast("double").alias("y"), F.col("is_returned").cast("double").alias("label"), weight.alias("weight")
    )
    vectors = assembler(["x", "y"]).transform(df).cache()
    for shape in ({"weightCol": "weight"}, {"maxDepth": 0}, {"maxBins": 400, "maxDepth": 7}):
        fitted = []
        for most in (0, 1 << 21):
            monkeypatch.setattr(forest, "WHOLE_ROWS", most)
            fitted.append(forest.Forest(featuresCol="_features", numTrees=11, minInstancesPerNode=3, seed=5, **shape).fit(vectors))
        one, other = ([m.getOrDefault(p) for p in ("feature", "cut", "leaf")] for m in fitted)
        assert one == other
        odd = spark.createDataFrame([(i, a, b) for i, a in enumerate((math.nan, math.inf, -math.inf, 0.5)) for b in (3.0, math.nan)], "id int, x double, y double")
        odd = VectorAssembler(inputCols=["x", "y"], outputCol="_features", handleInvalid="keep").transform(odd)
        found = []
        for most in (0, 1 << 22):
            monkeypatch.setattr(forest, "MOST_CELLS", most if shape.get("maxDepth") != 0 else 1)
            found.append([[r[0][1] for r in fitted[0].transform(rows).select("probability").collect()] for rows in (vectors, odd)])
        assert found[0] == found[1]
        feature, cut, leaf = one
        for row, got in zip(odd.collect(), found[0][1]):
            total = 0.0
            for fs, cs, vs in zip(feature, cut, leaf):
                at = 0
                while at < len(fs):
                    at = 2 * at + 1 + (cs[at] is not None and row["_features"][fs[at]] > cs[at])
                total += vs[at - len(fs)]
            assert got == pytest.approx(total / 11)


def test_forest_draws_and_cuts():
    from verisift.models import forest

    count = np.array([1] * 200_000 + [40] * 2000)
    drawn = forest._drawn(np.random.default_rng(1), count, 1.0)
    assert drawn[:200_000].mean() == pytest.approx(1, abs=0.02) and drawn[:200_000].var() == pytest.approx(1, abs=0.03)
    assert drawn[200_000:].mean() == pytest.approx(40, abs=1)
    rng = np.random.default_rng(2)
    bins, label = rng.integers(1, 6, (3, 400)).astype(np.uint8), rng.random(400) < 0.4
    for weight in (np.where(label, 2.0, 0.5), rng.integers(1, 9, 400) / 4):
        block = (0, bins, label, weight, np.ones(400, np.int64))
        found = (np.array([1]), np.array([2]), np.array([True, False]))
        picks = np.array([[0, 2], [1, 2]])
        sums = forest._sums(block, 3, 1, picks, found, 7, 9, 1.0)
        drawn = forest._drawn(np.random.default_rng([9, 3, 0, 2]), block[4], 1.0)
        hand = np.zeros_like(sums)
        for i in np.flatnonzero(bins[1] <= 2):
            for k, f in enumerate(picks[0]):
                hand[:, 0, k, bins[f, i], int(label[i])] += drawn[i], drawn[i] * weight[i]
        assert np.allclose(sums, hand)
        feature, cut, share, sides = forest._best(sums, picks, 5, 0.0)
        n, w = hand[0, 0], hand[1, 0]

        def loss(part):
            return part.sum() - (part**2).sum() / part.sum() if part.sum() else 0.0

        gains = {
            (k, c): (loss(w[k].sum(0)) - loss(w[k, : c + 1].sum(0)) - loss(w[k, c + 1 :].sum(0)))
            for k in range(2) for c in range(7)
            if n[k, : c + 1].sum() >= 5 and n[k, c + 1 :].sum() >= 5
        }
        k, c = max(gains, key=gains.get)
        assert (feature[0], cut[0], feature[1]) == (picks[0, k], c, -1)
        assert share[0] == pytest.approx(w[0, :, 1].sum() / w[0].sum())
        assert sides[0, 0] == pytest.approx(w[k, : c + 1, 1].sum() / w[k, : c + 1].sum())


def test_only_features_of_attributes_look_them_up(spark, layout, monkeypatch):
    from verisift.plans import jobs

    asked = []
    enrich = jobs.enrich
    monkeypatch.setattr(jobs, "enrich", lambda tx, **lookups: (asked.append({k for k, v in lookups.items() if v is not None}), enrich(tx, **lookups))[1])
    rows = [("c1", "p1", "2024-01-01", 2.0, "s1"), ("c1", "p2", "2024-01-05", 3.0, "s1"), ("c2", None, "2024-02-01", 1.0, "s2")]
    tx = spark.createDataFrame(rows, "customer_id string, product_id string, transaction_date string, gross_amount double, distributor_id string")
    tx = tx.withColumn("transaction_date", F.to_date("transaction_date"))
    products = spark.createDataFrame([("p1", "a"), ("p2", "b"), ("p2", "c")], "product_id string, product_category string")
    customers = spark.createDataFrame([("c1", "x")], "customer_id string, customer_segment string")
    written = jobs.feature_job({"transaction": tx, "product": products, "customer": customers}, layout)
    assert len(written) == 6 and sorted(map(len, asked)) == [0, 0, 0, 0, 1, 1] and {"products"} in asked
    found = jobs.read_feature_table(spark, layout, "customer_behavior", "mix_entropy").orderBy("customer_id").collect()
    assert [r[1] for r in found] == [1.0, 0.0]
