"""Feature catalog and lineage as tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import count

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from verisift.session import ensure_checkpoint_dir
from verisift.sources.feature_store import read_feature_table
from verisift.sources.layout import Layout

# Field names of a feature definition and of its stored row.
FEATURE_ROWS = (
    "asset_id STRING, name STRING, domain STRING, definition STRING, computation_logic STRING, "
    "source_lineage ARRAY<STRING>, version STRING, quality_expectations MAP<STRING,STRING>, "
    "registered_at TIMESTAMP"
)
LINEAGE_ROWS = "source STRING, target STRING, relation STRING"


@dataclass(frozen=True)
class FeatureDefinition:
    name: str
    domain: str
    definition: str
    computation_logic: str
    source_lineage: Sequence[str]
    version: str
    quality_expectations: Mapping[str, str] = field(default_factory=dict)


# -- catalog ---------------------------------------------------------------------


def register_feature(spark: SparkSession, layout: Layout, feature: FeatureDefinition) -> str:
    """Append a definition; the newest row of a (name, version) is the valid one."""
    asset_id = str(uuid.uuid5(uuid.NAMESPACE_URL, f"{feature.name}:{feature.version}"))
    row = (
        asset_id,
        feature.name,
        feature.domain,
        feature.definition,
        feature.computation_logic,
        list(feature.source_lineage),
        feature.version,
        {k: str(v) for k, v in feature.quality_expectations.items()},
    )
    columns = FEATURE_ROWS.rsplit(", registered_at", 1)[0]
    (
        spark.createDataFrame([row], columns)
        .withColumn("registered_at", F.current_timestamp())
        .write.mode("append")
        .parquet(layout.catalog("features"))
    )
    return asset_id


def registered_features(spark: SparkSession, layout: Layout) -> DataFrame:
    return spark.read.schema(FEATURE_ROWS).parquet(layout.catalog("features"))


def current_features(registrations: DataFrame) -> DataFrame:
    """The newest registration of every (name, version)."""
    whole = F.struct(*registrations.columns)
    # equal times are told apart by the row itself
    row = F.max_by(whole, F.struct("registered_at", F.xxhash64(F.to_json(whole))))
    return registrations.groupBy("name", "version").agg(row.alias("_row")).select("_row.*")


def search_features(
    registrations: DataFrame, query: str = "*", *, limit: int | None = None
) -> DataFrame:
    """Definitions whose name contains the keyword; ``*`` matches all.

    All of them, in no order; with a ``limit`` the first ones by name and version.
    """
    hits = registrations
    if query != "*":
        hits = hits.where(F.contains(F.lower("name"), F.lower(F.lit(query))))
    found = current_features(hits)
    return found if limit is None else found.orderBy("name", "version").limit(limit)


def get_feature_definition(registrations: DataFrame, name: str) -> DataFrame:
    """All current versions registered under exactly this name."""
    return current_features(registrations.where(F.col("name") == name))


# -- lineage ---------------------------------------------------------------------


def register_lineage(
    spark: SparkSession, layout: Layout, source: str, target: str, relation: str = "Data Flow"
) -> None:
    spark.createDataFrame([(source, target, relation)], LINEAGE_ROWS).write.mode("append").parquet(
        layout.catalog("lineage")
    )


def lineage_edges(spark: SparkSession, layout: Layout) -> DataFrame:
    return spark.read.schema(LINEAGE_ROWS).parquet(layout.catalog("lineage"))


def upstream(edges: DataFrame, assets: DataFrame, *, max_depth: int | None = None) -> DataFrame:
    """Everything the assets derive from: ``asset, upstream, depth`` (shortest distance).

    ``assets`` has one column ``asset``. The search goes one level at a time from the
    pairs found last and drops pairs seen before, so cycles end and shared ancestors
    are walked once. It ends with the level that adds nothing, or after ``max_depth`` levels
    if given. Each level is checkpointed, which keeps the plan short.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    links = edges.select(F.col("source").alias("_up"), F.col("target").alias("_down")).distinct()
    links = links.persist(StorageLevel.MEMORY_AND_DISK)
    frontier = assets.select("asset", F.col("asset").alias("upstream")).distinct()
    found = frontier.limit(0).withColumn("depth", F.lit(0))
    for depth in count(1) if max_depth is None else range(1, max_depth + 1):
        step = (
            frontier.join(links, F.col("upstream") == F.col("_down"))
            .select("asset", F.col("_up").alias("upstream"))
            .distinct()
            .join(found, ["asset", "upstream"], "left_anti")
            .where(F.col("asset") != F.col("upstream"))
            .checkpoint()
        )
        if step.isEmpty():
            break
        found = found.unionByName(step.withColumn("depth", F.lit(depth)))
        frontier = step
    links.unpersist()
    return found


# -- access ----------------------------------------------------------------------


class Features:
    """What a notebook or job needs of the catalog: a search, a definition, a stored table."""

    def __init__(self, spark: SparkSession, layout: Layout) -> None:
        self._spark = spark
        self._layout = layout

    def list_features(self, query: str = "*") -> DataFrame:
        return search_features(registered_features(self._spark, self._layout), query)

    def metadata(self, name: str) -> DataFrame:
        return get_feature_definition(registered_features(self._spark, self._layout), name)

    def get_feature(self, domain: str, name: str, *, version: int | None = None) -> DataFrame:
        return read_feature_table(self._spark, self._layout, domain, name, version=version)
