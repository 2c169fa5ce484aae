"""Saved stages: panels, forecasts and fitted models in shared storage."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from shelfcast.sources.tables import CSV_OPTIONS

STAGE_VERSION = 1


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def write_stage(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def scan_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


class StageStore:
    """Writes a stage once and reads it afterwards.

    The path carries a fingerprint of everything the stage was made with, so a
    change of settings never meets an old file. A stage counts as saved when its
    write was committed; a half-written one is built again.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str, settings: object) -> str:
        text = json.dumps([STAGE_VERSION, settings], sort_keys=True, default=repr)
        return f"{self.root}/{name}-{hashlib.md5(text.encode()).hexdigest()[:12]}"

    def is_saved(self, name: str, settings: object) -> bool:
        return self.version(name, settings) > 0

    def version(self, name: str, settings: object) -> int:
        """How often the stage was written; each time into a folder of its own, so that frames on older files stay valid."""
        n = 0
        while path_exists(self.spark, f"{self.version_path(name, settings, n + 1)}/_SUCCESS"):
            n += 1
        return n

    def version_path(self, name: str, settings: object, version: int) -> str:
        return f"{self.path(name, settings)}/v{version}"

    def saved_path(self, name: str, settings: object) -> str:
        return self.version_path(name, settings, self.version(name, settings))

    def table(
        self,
        name: str,
        settings: object,
        build: Callable[[], DataFrame],
        partition_by: Sequence[str] = (),
        refresh: bool = False,
    ) -> DataFrame:
        version = self.version(name, settings)
        if refresh or not version:
            version += 1
            write_stage(build(), self.version_path(name, settings, version), partition_by)
        return scan_stage(self.spark, self.version_path(name, settings, version))

    def part_paths(self, name: str, settings: object, parts: Sequence[str], version: int | None = None) -> dict[str, str]:
        """Where the frames of a stage lie: beside each other, the last one in the folder that commits them all."""
        path = self.version_path(name, settings, version or self.version(name, settings))
        return {p: path if p == parts[-1] else f"{path}-{p}" for p in parts}

    def tables(
        self,
        name: str,
        settings: object,
        build: Callable[[], Mapping[str, DataFrame]],
        parts: Mapping[str, Sequence[str]],
        refresh: bool = False,
    ) -> dict[str, DataFrame]:
        """As ``table``, for a stage of several frames: ``parts`` names them in the order they are written, with what each is split by."""
        version = self.version(name, settings)
        made = build() if refresh or not version else {}
        paths = self.part_paths(name, settings, list(parts), version + bool(made))
        for part, frame in made.items():
            write_stage(frame, paths[part], parts[part])
        return {part: scan_stage(self.spark, path) for part, path in paths.items()}


def write_predictions_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def save_model(model: PipelineModel, root: str, name: str) -> str:
    """Save under a time-stamped name and return the path; no earlier model is ever replaced."""
    path = f"{root.rstrip('/')}/{name}_{datetime.now():%Y%m%d_%H%M%S_%f}"
    model.save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
