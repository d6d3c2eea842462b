"""Validated settings for features, models, tuning, calibration and the feature store."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

# The metrics a model may be evaluated with, and the model's parameters with
# their defaults.
METRICS = ("accuracy", "roc_auc", "f1_score", "precision", "recall")
BOOSTING_DEFAULTS = {
    "n_estimators": 100,
    "learning_rate": 0.1,
    "max_depth": 3,
    "min_samples_split": 2,
    "min_samples_leaf": 1,
    "subsample": 1.0,
}


def _trimmed(spec: Any, attribute: str) -> None:
    text = getattr(spec, attribute)
    if not isinstance(text, str) or not text.strip():
        raise ValueError(f"{attribute} cannot be blank")
    object.__setattr__(spec, attribute, text.strip())


def _one_of(spec: Any, attribute: str, allowed: Sequence) -> None:
    if getattr(spec, attribute) not in allowed:
        raise ValueError(f"{attribute} must be one of {tuple(allowed)}, got {getattr(spec, attribute)!r}")


def _whole(name: str, value: Any, least: int) -> None:
    if isinstance(value, bool) or not isinstance(value, int):
        raise TypeError(f"{name} must be an integer")
    if value < least:
        raise ValueError(f"{name} must be at least {least}")


def _share(name: str, value: Any) -> None:
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        raise TypeError(f"{name} must be a number")
    if not 0 < value <= 1:
        raise ValueError(f"{name} must be above 0 and at most 1")


@dataclass(frozen=True, kw_only=True)
class FeatureSpec:
    """What to do with one feature; use one of the two kinds below."""

    feature_name: str
    enabled: bool = True
    imputer_enabled: bool = True
    description: str | None = None
    metadata: Mapping[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        _trimmed(self, "feature_name")

    def _needs_fill_value(self) -> None:
        if self.imputer_strategy == "constant" and self.imputer_fill_value is None:
            raise ValueError(f"{self.feature_name!r}: constant imputation needs imputer_fill_value")


@dataclass(frozen=True, kw_only=True)
class NumericFeatureSpec(FeatureSpec):
    imputer_strategy: str = "mean"
    imputer_fill_value: float | None = None
    scaler_type: str = "standard"
    scaler_enabled: bool = True

    def __post_init__(self) -> None:
        super().__post_init__()
        _one_of(self, "imputer_strategy", ("mean", "median", "constant"))
        _one_of(self, "scaler_type", ("standard", "robust", "none"))
        self._needs_fill_value()

    @property
    def feature_type(self) -> str:
        return "numeric"


@dataclass(frozen=True, kw_only=True)
class CategoricalFeatureSpec(FeatureSpec):
    imputer_strategy: str = "most_frequent"
    imputer_fill_value: str | None = None
    encoder_type: str = "onehot"
    encoder_enabled: bool = True

    def __post_init__(self) -> None:
        super().__post_init__()
        _one_of(self, "imputer_strategy", ("most_frequent", "constant"))
        _one_of(self, "encoder_type", ("onehot", "none"))
        self._needs_fill_value()

    @property
    def feature_type(self) -> str:
        return "categorical"


def numeric_features(names: Sequence[str], **settings: Any) -> list[NumericFeatureSpec]:
    """The same numeric treatment for several features."""
    return [NumericFeatureSpec(feature_name=n, **settings) for n in names]


def categorical_features(names: Sequence[str], **settings: Any) -> list[CategoricalFeatureSpec]:
    """The same categorical treatment for several features."""
    return [CategoricalFeatureSpec(feature_name=n, **settings) for n in names]


@dataclass(frozen=True, kw_only=True)
class FeatureSelection:
    """Which features to use: all, some positions, or some names."""

    selection_mode: str = "all"
    feature_indices: Sequence[int] | None = None
    feature_names: Sequence[str] | None = None
    exclude_features: Sequence[str] = ()
    max_features: int | None = None

    def __post_init__(self) -> None:
        _one_of(self, "selection_mode", ("all", "indices", "names"))
        if self.selection_mode == "indices" and not self.feature_indices:
            raise ValueError("selection by indices needs feature_indices")
        if self.selection_mode == "names" and not self.feature_names:
            raise ValueError("selection by names needs feature_names")
        if any(i < 0 for i in self.feature_indices or ()):
            raise ValueError("feature_indices cannot be negative")
        if self.max_features is not None:
            _whole("max_features", self.max_features, 1)

    def pick(self, available: Sequence[str]) -> list[str]:
        """Selected names; positions and names that do not exist are left out."""
        known = dict(enumerate(available))
        if self.selection_mode == "indices":
            chosen = [known[i] for i in self.feature_indices if i in known]
        elif self.selection_mode == "names":
            chosen = [n for n in self.feature_names if n in known.values()]
        else:
            chosen = list(available)
        return [n for n in chosen if n not in self.exclude_features][: self.max_features]


@dataclass(frozen=True, kw_only=True)
class ClassifierSpec:
    model_name: str
    algorithm: str = "gradient_boosting"
    hyperparameters: Mapping[str, Any] = field(default_factory=dict)
    evaluation_metrics: Sequence[str] = ("accuracy", "roc_auc", "f1_score")
    random_state: int | None = None
    enabled: bool = True
    description: str | None = None
    metadata: Mapping[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        _trimmed(self, "model_name")
        _one_of(self, "algorithm", ("gradient_boosting",))
        unknown = [m for m in self.evaluation_metrics if m not in METRICS]
        if unknown:
            raise ValueError(f"unknown metrics {unknown}; known are {METRICS}")
        if not self.hyperparameters:
            object.__setattr__(self, "hyperparameters", dict(BOOSTING_DEFAULTS))
        check_hyperparameters(self.hyperparameters)


def check_hyperparameters(values: Mapping[str, Any]) -> None:
    for name, value in values.items():
        if name in ("learning_rate", "subsample"):
            _share(name, value)
        elif name in ("n_estimators", "max_depth", "min_samples_leaf"):
            _whole(name, value, 1)
        elif name == "min_samples_split":
            _whole(name, value, 2)


@dataclass(frozen=True, kw_only=True)
class TuningSpec:
    tuning_name: str
    cv_strategy: str = "stratified_kfold"
    n_splits: int = 5
    scoring: str | Sequence[str] | Mapping[str, str] = "accuracy"
    refit_score: str = "accuracy"
    parallelism: int = 4
    return_train_score: bool = True
    random_state: int | None = None
    enabled: bool = True
    description: str | None = None
    metadata: Mapping[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        _trimmed(self, "tuning_name")
        _one_of(self, "cv_strategy", ("kfold", "stratified_kfold"))
        _whole("n_splits", self.n_splits, 2)
        _whole("parallelism", self.parallelism, 1)
        unknown = [m for m in self.scorers().values() if m not in SCORERS]
        if unknown:
            raise ValueError(f"unknown scorers {unknown}; known are {tuple(SCORERS)}")
        if self.refit_score not in self.scorers():
            if len(self.scorers()) > 1 or self.refit_score != "accuracy":
                raise ValueError(f"refit_score {self.refit_score!r} is not among the scorers")
            object.__setattr__(self, "refit_score", next(iter(self.scorers())))

    def scorers(self) -> dict[str, str]:
        """Name of each score and the metric behind it."""
        if isinstance(self.scoring, str):
            return {self.scoring: self.scoring}
        if isinstance(self.scoring, Mapping):
            return dict(self.scoring)
        return {m: m for m in self.scoring}


# Names a scorer may have, and the metric each stands for.
SCORERS = {
    "accuracy": "accuracy",
    "roc_auc": "roc_auc",
    "f1": "f1_score",
    "f1_score": "f1_score",
    "precision": "precision",
    "recall": "recall",
}


@dataclass(frozen=True, kw_only=True)
class GridSearchSpec(TuningSpec):
    param_grid: Mapping[str, Sequence] = field(default_factory=dict)

    @property
    def tuning_type(self) -> str:
        return "grid_search"


@dataclass(frozen=True, kw_only=True)
class RandomSearchSpec(TuningSpec):
    param_distributions: Mapping[str, Sequence] = field(default_factory=dict)
    n_iter: int = 10

    def __post_init__(self) -> None:
        super().__post_init__()
        _whole("n_iter", self.n_iter, 1)

    @property
    def tuning_type(self) -> str:
        return "random_search"


@dataclass(frozen=True, kw_only=True)
class CalibrationSpec:
    calibration_name: str
    method: str = "sigmoid"
    cv_strategy: str | int = "prefit"
    n_splits: int = 5
    ensemble: bool = True
    random_state: int | None = None
    enabled: bool = True
    description: str | None = None
    metadata: Mapping[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        _trimmed(self, "calibration_name")
        _one_of(self, "method", ("sigmoid", "isotonic"))
        _whole("n_splits", self.n_splits, 2)
        if isinstance(self.cv_strategy, str):
            _one_of(self, "cv_strategy", ("prefit", "kfold", "stratified_kfold"))
        else:
            _whole("cv_strategy", self.cv_strategy, 2)

    @property
    def folds(self) -> int:
        """Number of folds; an integer strategy is that many shuffled folds."""
        return self.cv_strategy if isinstance(self.cv_strategy, int) else self.n_splits


@dataclass(frozen=True, kw_only=True)
class Entity:
    name: str = "sample"
    join_keys: Sequence[str] = ("sample_index",)
    description: str | None = None

    def __post_init__(self) -> None:
        _trimmed(self, "name")
        if not self.join_keys:
            raise ValueError("an entity needs at least one join key")


@dataclass(frozen=True, kw_only=True)
class FeatureView:
    """Features of one entity: where they are read from and how long they stay valid."""

    view_name: str
    source: Any
    features: Sequence[str]
    entity: Entity = field(default_factory=Entity)
    ttl_days: int = 365
    tags: Mapping[str, str] = field(default_factory=dict)
    online: bool = True
    description: str | None = None

    def __post_init__(self) -> None:
        _trimmed(self, "view_name")
        if self.description is None:
            text = f"{len(self.features)} features of view {self.view_name}"
            object.__setattr__(self, "description", text)


@dataclass(frozen=True, kw_only=True)
class FeatureStoreSpec:
    """How the workflow gets its training rows from a feature table."""

    enabled: bool = False
    project_name: str = "ml_workflow"
    dataset_name: str = "classification_data"
    feature_view_name: str = "classification_features"
    n_features: int | None = None
    offline_store_type: str = "file"
    online_store_type: str | None = None
    use_full_feature_names: bool = False
    timestamp: datetime | None = None
    materialize_online: bool = False
    ttl_days: int = 365
    sample_indices: Sequence[int] | None = None

    def __post_init__(self) -> None:
        for attribute in ("project_name", "dataset_name", "feature_view_name"):
            _trimmed(self, attribute)
        _whole("ttl_days", self.ttl_days, 1)
        if self.n_features is not None:
            _whole("n_features", self.n_features, 1)
            if self.n_features > 1000:
                raise ValueError("n_features must be at most 1000")
        _one_of(self, "offline_store_type", ("file", "spark"))
        _one_of(self, "online_store_type", ("sqlite", "redis", None))

    def should_materialize(self) -> bool:
        return self.enabled and self.materialize_online and self.online_store_type is not None
