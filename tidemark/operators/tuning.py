"""Hyperparameter search by cross-validation."""

from __future__ import annotations

import itertools
import json
import math
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.checks import class_list
from tidemark.operators.model import ClassifierPipeline, FittedClassifier, evaluate_scored
from tidemark.operators.splits import kfold, stratified_kfold
from tidemark.session import write_through
from tidemark.specs import SCORERS, GridSearchSpec, RandomSearchSpec, TuningSpec

FOLD_SCORES = "candidate int, params string, fold int, part string, metric string, score double"


def candidates(spec: TuningSpec) -> list[dict[str, Any]]:
    """Parameter combinations: the whole grid, or a seeded sample of it without repeats."""
    if isinstance(spec, GridSearchSpec):
        grid = spec.param_grid
    elif isinstance(spec, RandomSearchSpec):
        grid = spec.param_distributions
    else:
        raise TypeError(f"spec must be a grid or random search, got {type(spec).__name__}")
    if not isinstance(grid, Mapping) or not grid or not all(len(v) for v in grid.values()):
        raise ValueError("the parameter grid must not be empty")
    names = sorted(grid)
    if isinstance(spec, RandomSearchSpec):
        size = math.prod(len(grid[n]) for n in names)
        drawn = random.Random(spec.random_state).sample(range(size), min(spec.n_iter, size))
        return [_combination(grid, names, number) for number in drawn]
    return [dict(zip(names, values)) for values in itertools.product(*[grid[n] for n in names])]


def _combination(grid: Mapping[str, Sequence], names: Sequence[str], number: int) -> dict[str, Any]:
    """The combination of that number when the last name varies fastest."""
    found = {}
    for name in reversed(names):
        number, at = divmod(number, len(grid[name]))
        found[name] = grid[name][at]
    return {n: found[n] for n in names}


def shared_fits(parameters: Sequence[Mapping[str, Any]]) -> list[list[tuple[int, int | None]]]:
    """Candidates that differ only in their number of rounds: (candidate, rounds), most rounds first.

    Boosting adds its rounds one after the other, so a fit with most rounds holds all of them.
    """
    groups: dict[str, list[tuple[int, int | None]]] = {}
    for i, own in enumerate(parameters):
        names = [n for n in own if n.removeprefix("classifier__").removeprefix("model__") == "n_estimators"]
        rest = {n: v for n, v in own.items() if n not in names}
        key = json.dumps([bool(names), rest], sort_keys=True, default=repr)
        groups.setdefault(key, []).append((i, own[names[0]] if names else None))
    return [sorted(g, key=lambda c: (-(c[1] or 0), c[0])) for g in groups.values()]


def cv_results(scores: DataFrame, by: Sequence[str] = ("candidate",), score: str = "score") -> DataFrame:
    """Mean, population deviation and rank of every candidate's fold scores.

    The rank is taken over one row per candidate.
    """
    table = scores.groupBy(*by).agg(
        F.count(score).alias("n_folds"), F.avg(score).alias("mean_score"), F.stddev_pop(score).alias("std_score")
    )
    best_first = Window.orderBy(F.desc("mean_score"))
    return table.withColumn("rank", F.rank().over(best_first))


@dataclass
class SearchResult:
    """What a search found: the scores of every fold and the refitted best pipeline."""

    spec: TuningSpec
    parameters: list[dict[str, Any]]
    fold_scores: DataFrame
    best_index: int
    best_score: float
    best_pipeline: ClassifierPipeline
    best_model: FittedClassifier

    @property
    def best_params(self) -> dict[str, Any]:
        return self.parameters[self.best_index]

    def cv_results(self) -> DataFrame:
        """One row per candidate: mean, deviation and rank of the deciding score, train mean."""
        mine = self.fold_scores.filter(F.col("metric") == self.spec.refit_score)
        test = cv_results(mine.filter("part = 'test'"), ("candidate", "params"))
        train = mine.filter("part = 'train'").groupBy("candidate").agg(F.avg("score").alias("mean_train_score"))
        return test.join(train, "candidate", "left")

    def summary(self) -> dict[str, Any]:
        return {
            "tuning_name": self.spec.tuning_name,
            "tuning_type": self.spec.tuning_type,
            "best_score": self.best_score,
            "best_params": self.best_params,
            "n_splits": self.spec.n_splits,
            "cv_strategy": self.spec.cv_strategy,
        }


def search(
    spec: TuningSpec,
    pipeline: ClassifierPipeline,
    df: DataFrame,
    label: str,
    key: str,
    default_seed: int = 42,
    stored: bool = False,
) -> SearchResult:
    """Score every candidate on every fold, then refit the best one on all rows.

    The needed columns are written once with their fold; if ``df`` is ``stored``, a table that
    is cheap to read again, its rows are tagged while they are read instead. Preprocessing is
    fitted for all folds in one pass and shared by the candidates, and candidates that differ only in their
    number of rounds share one fit, of which the first rounds are scored. Fits run side by side from a few driver
    threads; the rows stay on the executors and only the scores come back.
    """
    if not isinstance(spec, TuningSpec):
        raise TypeError(f"spec must be a TuningSpec, got {type(spec).__name__}")
    params = candidates(spec)
    seed = spec.random_state if spec.random_state is not None else default_seed
    classes = class_list(df, label)
    if "roc_auc" in {SCORERS[m] for m in spec.scorers().values()} and len(classes) != 2:
        raise ValueError("the area under the ROC curve needs two classes")
    narrow = df.select(*dict.fromkeys([key, *pipeline.input_columns(df), label]))
    if spec.cv_strategy == "kfold":
        folded = kfold(narrow, key, spec.n_splits, seed, fold="_fold")
    else:
        folded = stratified_kfold(narrow, key, label, spec.n_splits, seed, fold="_fold")
    if not stored:
        folded = write_through(folded, "folds", "_fold")
    scorers = {name: SCORERS[metric] for name, metric in spec.scorers().items()}
    metrics, size = sorted(set(scorers.values())), folded.count()

    def run(task: tuple[int, list[tuple[int, int | None]]]) -> list[tuple]:
        fold, group = task
        train = folded.filter(F.col("_fold") != fold)
        trial = pipeline.with_parameters(params[group[0][0]])
        model = trial.fit(train, label, classes, prep=fitted[fold])
        found = []
        for candidate, rounds in group:
            own = model if rounds in (None, group[0][1]) else model.first(rounds)
            found += scores_of(own, candidate, fold)
        return found

    def scores_of(model: FittedClassifier, candidate: int, fold: int) -> list[tuple]:
        # One scoring pass gives the scores of the fold and of the rows the model has seen.
        rows = folded if spec.return_train_score else folded.filter(F.col("_fold") == fold)
        part = F.when(F.col("_fold") == fold, "test").otherwise("train").alias("part")
        scored = model.transform(rows).select(part, label, "prediction", "probability")
        found = {
            (r["part"], r["metric"]): r["value"]
            for r in evaluate_scored(scored, label, classes, metrics, ["part"], size).collect()
        }
        text = json.dumps(params[candidate], sort_keys=True)
        parts = sorted({part for part, _ in found})
        return [(candidate, text, fold, p, n, found.get((p, m))) for p in parts for n, m in scorers.items()]

    folds = range(spec.n_splits)
    fitted = pipeline.prep.fit_folds(folded, "_fold", spec.n_splits)
    with ThreadPoolExecutor(spec.parallelism) as pool:
        scores = [r for rows in pool.map(run, itertools.product(folds, shared_fits(params))) for r in rows]

    frame = df.sparkSession.createDataFrame(scores, FOLD_SCORES)
    tests = [r for r in scores if r[3] == "test" and r[4] == spec.refit_score]
    # A fold without a defined score leaves the candidate without a mean, and ranks it last.
    of = [[r[5] for r in tests if r[0] == c] for c in range(len(params))]
    means = [sum(x) / spec.n_splits if x and None not in x else -math.inf for x in of]
    best = max(range(len(params)), key=lambda c: (means[c], -c))
    chosen = pipeline.with_parameters(params[best])
    model = chosen.fit(folded, label, classes)
    return SearchResult(spec, params, frame, best, means[best], chosen, model)
