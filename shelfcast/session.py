"""Where shared files go, and how many tasks a grid gets."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from shelfcast.sources.stages import path_exists
from shelfcast.spec import PanelSpec

CHECKPOINT_CONF = "spark.checkpoint.dir"
_places: WeakKeyDictionary = WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that the session names in ``spark.checkpoint.dir``.

    Where it is unset, one is made and put into the session, but only if driver
    and executors are one process; any cluster, also a local one, gets an error.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if not named:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="shelfcast-")
        spark.conf.set(CHECKPOINT_CONF, named)
    return named.rstrip("/")


@contextmanager
def co_located(spark: SparkSession) -> Iterator[None]:
    """While this lasts, joins by several keys use a layout by one of them that both sides have, and shuffle neither again."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def dealt_by(spark: SparkSession, spec: PanelSpec, other: str) -> list[str]:
    """What rows by shop and ``other`` are dealt out by before they are joined: ``other`` alone inside ``co_located``, else both keys,
    the only layout that Spark then takes for a join by both without another shuffle."""
    alone = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "false"
    return [other] if alone else [spec.shop, other]


def free_shuffles(spark: SparkSession) -> None:
    """Let the executors delete the shuffle files of finished jobs now; they go when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _new_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/written/{uuid.uuid4().hex}"


def written_down(df: DataFrame) -> DataFrame:
    """Cut the lineage of a result by a table in the shared folder.

    Unlike a checkpoint, the files tell Spark their size, by which it decides
    how to join them.
    """
    spark = df.sparkSession
    path = _new_path(spark)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _places[table] = path
    return table


def drop_written(table: DataFrame) -> None:
    """Delete the files of a ``written_down`` table that nothing reads any more."""
    spark = table.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(_places.pop(table))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def written_by_value(df: DataFrame, column: str, values: Sequence[str]) -> dict[str, DataFrame]:
    """As ``written_down``, in one table for each of the few ``values`` of a column, each with a size of its own."""
    spark = df.sparkSession
    path = _new_path(spark)
    df.write.partitionBy(column).parquet(path)
    rest = df.drop(column)
    return {
        v: spark.read.schema(rest.schema).parquet(f"{path}/{column}={v}") if path_exists(spark, f"{path}/{column}={v}") else rest.limit(0)
        for v in values
    }


def grid_tasks(spark: SparkSession, spec: PanelSpec) -> int:
    """Number of tasks the entity grid is spread over before it grows by the periods: one per core, or as told.

    Not the number of shuffle partitions, which does not know how many cells a row becomes; ``operators.grid.sized`` tells by the cells.
    """
    return spec.partitions or spark.sparkContext.defaultParallelism
