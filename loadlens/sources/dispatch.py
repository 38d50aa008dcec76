"""One entry for the ways to get requests."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from loadlens.functions.paths import IMAGE_SUFFIXES
from loadlens.operators.decode import decode_requests
from loadlens.sources import files, tables, topics


@dataclass(frozen=True)
class SourceSpec:
    """Where requests come from. The first location set wins, in the order of the fields."""

    object_store: str | None = None
    topic: str | None = None
    servers: str | None = None
    manifest: str | None = None
    tree: str | None = None
    labels: Sequence[str] | None = None
    suffixes: Sequence[str] = IMAGE_SUFFIXES
    manifest_layout: str = "auto"
    topic_options: dict[str, str] = field(default_factory=dict)


def load_requests(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    if spec.object_store:
        return files.list_unlabelled(spark, spec.object_store, spec.suffixes, ignore_case=True)
    if spec.topic:
        if not spec.servers:
            raise ValueError("a topic needs its servers")
        raw = topics.read_topic(spark, spec.servers, spec.topic, **spec.topic_options)
        return decode_requests(raw)
    if spec.manifest:
        return tables.read_manifest(spark, spec.manifest, spec.manifest_layout)
    if spec.tree:
        return files.list_labelled(spark, spec.tree, spec.labels, spec.suffixes)
    raise ValueError("name an object store, a topic, a manifest or a tree")
