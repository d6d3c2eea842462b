"""A feature store over tables: registered views, historical and latest features."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.asof import as_of_join, entity_values
from tidemark.operators.latest import LatestTable
from tidemark.sources.tables import read_table
from tidemark.specs import FeatureView


class FeatureStore:
    """Reads features of registered views as of a moment, or their latest values.

    ``online_root`` is the folder of the latest-value tables; without it only historical
    features can be read.
    """

    def __init__(self, spark: SparkSession, online_root: str | None = None) -> None:
        self.spark = spark
        self.online_root = online_root
        self.views: dict[str, FeatureView] = {}

    def register(self, views: FeatureView | Sequence[FeatureView]) -> None:
        for view in [views] if isinstance(views, FeatureView) else views:
            self.views[view.view_name] = view

    def get_features(
        self,
        entities: DataFrame,
        features: Sequence[str],
        view: str | None = None,
        full_names: bool = False,
        **options,
    ) -> DataFrame:
        """Entity rows with features as of their ``event_timestamp``.

        Features are names within ``view``, or ``view:feature`` references, which may come
        from several views.
        """
        joined = entities
        for name, wanted in self._by_view(features, view).items():
            found = self._view(name)
            rows = found.source.read(self.spark)
            joined = as_of_join(
                joined,
                rows,
                found.entity.join_keys,
                found.source.timestamp_column,
                wanted,
                created=found.source.created_column,
                ttl=timedelta(days=found.ttl_days),
                view=name,
                full_names=full_names,
                **options,
            )
        return joined

    def get_training_data(
        self,
        entities: DataFrame,
        feature_names: Sequence[str],
        target: str,
        view: str,
        full_names: bool = False,
        **options,
    ) -> DataFrame:
        """Keys, features and target of every entity row."""
        joined = self.get_features(entities, [*feature_names, target], view, full_names, **options)
        prefix = f"{view}__" if full_names else ""
        keys = self._view(view).entity.join_keys
        return joined.select(*keys, *[prefix + c for c in [*feature_names, target]])

    def get_entity_values(self, entity_column: str, view: str | None = None, path: str | None = None) -> DataFrame:
        """The different values of an entity column in a view's table, or in the table at a path."""
        if view is None and path is None:
            raise ValueError("a view or a path is needed")
        df = self._view(view).source.read(self.spark) if view else read_table(self.spark, path)
        return entity_values(df, entity_column)

    def materialize(self, view: str, start: datetime, end: datetime) -> LatestTable:
        """Bring the latest values of ``[start, end]`` into the view's latest table."""
        found = self._view(view)
        return self.latest(view).materialize(found.source.read(self.spark), found.features, start, end)

    def materialize_incremental(self, view: str, end: datetime | None = None) -> LatestTable:
        """Bring in what is newer than the last materialisation, up to ``end`` or now."""
        found = self._view(view)
        return self.latest(view).materialize_incremental(found.source.read(self.spark), found.features, end)

    def get_online_features(
        self, keys: DataFrame, features: Sequence[str], view: str | None = None, full_names: bool = False
    ) -> DataFrame:
        """The given rows with the latest materialised features of their keys."""
        joined = keys
        for name, wanted in self._by_view(features, view).items():
            joined = self.latest(name).lookup(joined, wanted, name, full_names)
        return joined

    def latest(self, view: str) -> LatestTable:
        if self.online_root is None:
            raise RuntimeError("online features need an online_root")
        found = self._view(view)
        return LatestTable(
            self.spark,
            f"{self.online_root.rstrip('/')}/{view}",
            found.entity.join_keys,
            found.source.timestamp_column,
            found.source.created_column,
        )

    def _view(self, name: str) -> FeatureView:
        if name not in self.views:
            raise ValueError(f"feature view {name!r} is not registered")
        return self.views[name]

    def _by_view(self, features: Sequence[str], view: str | None) -> dict[str, list[str]]:
        wanted: dict[str, list[str]] = {}
        for reference in features:
            owner, colon, feature = reference.rpartition(":")
            owner = owner if colon else view
            if not owner:
                raise ValueError(f"{reference!r} names no view")
            wanted.setdefault(owner, []).append(feature)
        return wanted
