"""Versions of fitted models, each visible only when it is whole.

``save_models`` writes all models of a version below ``root/v<number>-<id>`` and then
names the folder in a small marker, ``root/_versions/v<number>.json``, that cannot
be overwritten. A reader takes the newest marker, so it never loads half a
version, and a version that is in use is not changed."""

from __future__ import annotations

import json
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from ..operators.ml import load_model, save_model
from .publish import Files


def _marker(root: str, version: int) -> str:
    return f"{root}/_versions/v{version:010d}.json"


def newest_version(spark: SparkSession, root: str) -> int:
    """The number of the newest whole version; 0 if there is none."""
    names = Files(spark, root).names(f"{root}/_versions")
    return max((int(n[1:-5]) for n in names if n.endswith(".json")), default=0)


def save_models(spark: SparkSession, models: dict[str, PipelineModel], root: str) -> int:
    """Write a new version and return its number."""
    files = Files(spark, root)
    folder = f"m-{uuid.uuid4().hex[:12]}"
    for name, model in models.items():
        save_model(model, f"{root}/{folder}/{name}")
    about = json.dumps({"folder": folder, "models": sorted(models)})
    while True:
        version = newest_version(spark, root) + 1
        if files.write_new(_marker(root, version), about):
            return version


def load_models(spark: SparkSession, root: str, version: int) -> dict[str, PipelineModel]:
    """All models of a version; none for version 0."""
    if not version:
        return {}
    about = json.loads(Files(spark, root).read(_marker(root, version)))
    return {name: load_model(f"{root}/{about['folder']}/{name}") for name in about["models"]}
