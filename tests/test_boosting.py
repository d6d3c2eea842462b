"""Joint boosting against a plain version, its settings, and fits that share their rounds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import boosting, model, prep, tuning
from tidemark.operators.model import ClassifierPipeline
from tidemark.specs import ClassifierSpec, GridSearchSpec, categorical_features, numeric_features

NAMES = ["a", "b", "c"]


def made(n, classes, seed=0, values=9):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, values, size=(n, 3)) / 2.0
    score = x[:, 0] + np.where(x[:, 1] > 2, 2.0, 0.0) + rng.normal(size=n)
    return x, np.searchsorted(np.quantile(score, np.arange(1, classes) / classes), score)


def frame(spark, x, y, partitions=3):
    return spark.createDataFrame([(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))], "id long, a double, b double, c double, y int").repartition(partitions)


def plain(x, y, classes, rounds, depth, rate=0.1, split_rows=2, leaf_rows=1):
    """Probabilities of joint boosting with exhaustive cuts, one row and one cut at a time."""
    n, outputs = len(x), 1 if classes == 2 else classes
    p = np.bincount(y, minlength=classes) / n
    raw = np.tile([np.log(p[1] / p[0])] if outputs == 1 else np.log(p), (n, 1))
    sizes = []
    for _ in range(rounds):
        own = boosting.shares(raw)
        step = np.zeros_like(raw)
        for k in range(outputs):
            r = (y == (1 if outputs == 1 else k)) - own[:, 1 if outputs == 1 else k]
            w = own[:, 1] * own[:, 0] if outputs == 1 else np.abs(r) * (1 - np.abs(r))

            def grow(rows, level):
                best = (1e-12, None)
                if level < depth and len(rows) >= split_rows:
                    for j in range(x.shape[1]):
                        for v in np.unique(x[rows, j])[:-1]:
                            low = x[rows, j] <= v
                            if min(low.sum(), (~low).sum()) >= leaf_rows:
                                gain = low.sum() * (~low).sum() / len(rows) * (r[rows[low]].mean() - r[rows[~low]].mean()) ** 2
                                best = (gain, (j, v)) if gain > best[0] * (1 + 1e-9) else best
                if best[1] is None:
                    sizes.append(len(rows))
                    step[rows, k] = rate * (1 if outputs == 1 else (outputs - 1) / outputs) * r[rows].sum() / w[rows].sum()
                    return
                low = x[rows, best[1][0]] <= best[1][1]
                grow(rows[low], level + 1)
                grow(rows[~low], level + 1)

            grow(np.arange(n), 0)
        raw = raw + step
    return boosting.shares(raw), sizes


def fitted(df, **settings):
    spec = ClassifierSpec(model_name="m", hyperparameters=settings, random_state=3)
    return ClassifierPipeline(numeric_features(NAMES), spec).fit(df, "y")


def scored(fit, df):
    return np.array([r.probability for r in fit.transform(df).orderBy("id").collect()])


@pytest.mark.parametrize("classes, settings", [
    (3, {"n_estimators": 5, "max_depth": 2}),
    (4, {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.5, "min_samples_leaf": 15}),
    (2, {"n_estimators": 4, "max_depth": 3, "min_samples_split": 60}),
    (3, {"n_estimators": 2, "max_depth": 4, "min_samples_split": 90}),
])
def test_equals_plain_boosting(spark, monkeypatch, classes, settings):
    monkeypatch.setattr(boosting, "REFRESH", 2)
    monkeypatch.setattr(boosting, "HISTOGRAM_BYTES", 24 * 3 * 9 * 2)  # two nodes at a time
    x, y = made(400, classes)
    df = frame(spark, x, y)
    fit = fitted(df, **settings)
    wanted, _ = plain(x, y, classes, settings["n_estimators"], settings["max_depth"], settings.get("learning_rate", 0.1), settings.get("min_samples_split", 2), settings.get("min_samples_leaf", 1))
    assert np.allclose(scored(fit, df), wanted)
    assert sum(r.importance for r in fit.importance().collect()) == pytest.approx(1.0)
    found = fit.transform(df).select("probability", "prediction").collect()
    assert all(r.prediction == int(np.argmax(r.probability)) for r in found)


def test_split_setting_changes_the_trees(spark):
    x, y = made(400, 2)
    trees = fitted(frame(spark, x, y), n_estimators=1, max_depth=3, min_samples_split=150).trees.rounds[0][0]
    _, sizes = plain(x, y, 2, 1, 3, split_rows=150)
    assert trees.feature.count(-1) == len(sizes) < 8


def test_many_values_are_cut_at_quantiles(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 3))
    y = np.digitize(x[:, 0] + 0.2 * rng.normal(size=3000), [-0.5, 0.5])
    df = frame(spark, x, y)
    fit = fitted(df, n_estimators=10, max_depth=2, learning_rate=0.3)
    assert all(len(e) < boosting.MAX_BINS for e in fit.trees.edges)
    assert (scored(fit, df).argmax(axis=1) == y).mean() > 0.85


def test_subsample_is_the_same_for_any_partitioning(spark):
    x, y = made(300, 3)
    df = frame(spark, x, y, 1)
    a, b = (scored(fitted(df, n_estimators=3, max_depth=2, subsample=0.5), df) for _ in range(2))
    assert np.array_equal(a, b) and not np.allclose(a, scored(fitted(df, n_estimators=3, max_depth=2), df))


def test_one_value_and_missing_class(spark):
    df = frame(spark, np.ones((30, 3)), np.arange(30) % 3)
    assert np.allclose(scored(fitted(df, n_estimators=2, max_depth=2), df), 1 / 3)


@pytest.mark.parametrize("classes", [2, 3])
def test_first_rounds_are_a_shorter_fit(spark, classes):
    x, y = made(200, classes)
    df = frame(spark, x, y)
    long, short = (fitted(df, n_estimators=n, max_depth=2) for n in (6, 2))
    assert np.allclose(scored(long.first(2), df), scored(short, df))
    assert not np.allclose(scored(long, df), scored(short, df))


def test_candidates_share_fits(spark, monkeypatch):
    x, y = made(240, 2)
    df = frame(spark, x, y)
    pipeline = ClassifierPipeline(numeric_features(NAMES), ClassifierSpec(model_name="m", hyperparameters={"max_depth": 2}, random_state=1))
    grid = {"classifier__n_estimators": [4, 1, 2], "classifier__max_depth": [1, 2]}
    spec = GridSearchSpec(tuning_name="g", param_grid=grid, n_splits=2, random_state=5, parallelism=1)
    fits, fit = [], model.fit_trees
    monkeypatch.setattr(model, "fit_trees", lambda *a: fits.append(a) or fit(*a))
    found = tuning.search(spec, pipeline, df, "y", "id")
    assert len(fits) == 2 * 2 + 1  # two depths, two folds, and the refit
    alone = {}
    monkeypatch.setattr(tuning, "shared_fits", lambda params: [[(i, None)] for i in range(len(params))])
    for r in tuning.search(spec, pipeline, df, "y", "id").fold_scores.collect():
        alone[r.candidate, r.fold, r.part, r.metric] = r.score
    assert {(r.candidate, r.fold, r.part, r.metric): r.score for r in found.fold_scores.collect()} == alone


def test_shared_fits():
    params = [{"classifier__n_estimators": n, "classifier__max_depth": d} for n in (50, 100) for d in (2, 3)] + [{"classifier__max_depth": 2}]
    assert tuning.shared_fits(params) == [[(2, 100), (0, 50)], [(3, 100), (1, 50)], [(4, None)]]


def test_folds_are_fitted_in_one_pass(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, i % 4, None if i % 7 == 0 else float(rng.normal()), float("nan") if i % 5 == 0 else float(i), rng.choice(["u", "v", "w", None]), f"c{i % 13}") for i in range(300)]
    df = spark.createDataFrame(rows, "id int, fold int, m double, q double, s string, t string").repartition(3)
    numeric = numeric_features(["m"]) + numeric_features(["q"], imputer_strategy="median", scaler_type="robust")
    pipeline = model.FeaturePipeline(numeric + categorical_features(["s", "t"]))
    for fold, found in enumerate(pipeline.fit_folds(df, "fold", 4)):
        alone = pipeline.fit(df.filter(F.col("fold") != fold))
        for f, g in zip(found.features, alone.features):
            assert (f.fill, f.centre, f.scale) == pytest.approx((g.fill, g.centre, g.scale)) if not f.categories else f.fill == g.fill
            assert f.categories == g.categories
    with pytest.raises(ValueError, match="without any value"):
        pipeline.fit_folds(df.withColumn("m", F.when(F.col("fold") == 1, F.col("m"))), "fold", 4)


def one_hot_model(df, limit, monkeypatch, classes, **settings):
    monkeypatch.setattr(prep, "MAX_CATEGORIES", limit)
    spec = ClassifierSpec(model_name="trees", hyperparameters={"n_estimators": 2, "max_depth": 2, "min_samples_split": 3, **settings}, random_state=1)
    specs = [*categorical_features(["kind"]), *numeric_features(["a"])]
    return ClassifierPipeline(specs, spec).fit(df, "y")


@pytest.mark.parametrize("classes", [2, 3])
def test_many_categories_split_as_one_hot_columns_do(spark, monkeypatch, classes):
    rng = np.random.default_rng(3)
    kind, a = rng.integers(0, 12, size=400), rng.integers(0, 7, size=400) / 2.0
    y = (kind % classes + (a > 2) + (rng.random(400) < 0.1)) % classes
    rows = [(i, None if i % 50 == 0 else f"k{k:02d}", float(v), int(t)) for i, (k, v, t) in enumerate(zip(kind, a, y))]
    df = spark.createDataFrame(rows, "id long, kind string, a double, y int").repartition(3)
    narrow, wide = (one_hot_model(df, limit, monkeypatch, classes) for limit in (1_000, 1))
    assert narrow.trees.places == {} and wide.trees.places == {0: 11}
    asked = df.unionByName(df.limit(5).withColumn("kind", F.lit("never seen")).withColumn("id", -1 - F.col("id")))
    found = [{r["id"]: r["probability"] for r in m.transform(asked).collect()} for m in (narrow, wide)]
    assert wide.transform(asked).columns == [*asked.columns, "probability", "prediction"]
    assert set(found[0]) == set(found[1]) and len(found[0]) == 405
    assert max(abs(np.array(found[0][i]) - np.array(found[1][i])).max() for i in found[0]) < 1e-9
    shares = {r.feature: r.importance for r in wide.importance().collect()}
    single = {r.feature: r.importance for r in narrow.importance().collect()}
    assert shares["a"] == pytest.approx(single["a"]) and shares["kind_position"] == pytest.approx(1 - single["a"])


def test_bins_beyond_a_byte(spark, monkeypatch):
    df = spark.range(700).select("id", F.format_string("k%03d", F.col("id") % 350).alias("kind"), (F.col("id") % 5).cast("double").alias("a"), (F.col("id") % 350 == 300).cast("int").alias("y"))
    model = one_hot_model(df, 1, monkeypatch, 2, n_estimators=3, learning_rate=1.0)
    found = {r["id"]: r["prediction"] for r in model.transform(df).collect()}
    assert sorted(i for i, p in found.items() if p) == [300, 650]


def test_checks_before_training_allow_positions(spark, monkeypatch):
    monkeypatch.setattr(prep, "MAX_CATEGORIES", 1)
    df = spark.createDataFrame([(1.0, "a", 0), (2.0, "b", 1), (3.0, "c", 1)], "a double, kind string, y int")
    spec = ClassifierSpec(model_name="trees", hyperparameters={"n_estimators": 1})
    pipeline = ClassifierPipeline([*categorical_features(["kind"]), *numeric_features(["a"])], spec)
    assert model.check_rows(df, pipeline, "y").output_names() == ["kind_position", "a"]
