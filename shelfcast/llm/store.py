"""Intermediate tables in the folder that the cluster shares, and row packing."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where it is unset, one is made and set in local mode only."""
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set(CHECKPOINT_CONF, named)
    return named.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A folder in the shared one that nothing has written to yet."""
    return f"{shared_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def saved(df: DataFrame, name: str, *, by: str | None = None, compression: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    writer = df.write if by is None else df.write.partitionBy(by)
    writer.parquet(path, compression=compression)
    table = spark.read.schema(df.schema).parquet(path)
    _places[table] = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete the files of saved tables that nothing reads any more, and the shuffles of the jobs behind them."""
    for table in tables:
        path = _places.pop(table, None)
        if path is not None:
            remove(table.sparkSession, path)
    if tables:
        free_shuffles(tables[0].sparkSession)


_places: WeakKeyDictionary = WeakKeyDictionary()
_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Give the executors this package, which the driver may have from a folder that they don't see."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="llm-code-")), "shelfcast_llm.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder in ("", "llm"):
            for name in sorted(os.listdir(os.path.join(package, folder))):
                if name.endswith(".py"):
                    z.write(os.path.join(package, folder, name), os.path.join(os.path.basename(package), folder, name))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def arrow_rows(spark: SparkSession, rows: int) -> None:
    """Make ready for Python in tasks; ``rows`` go there at once, far fewer than Spark's default as texts are long."""
    _ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def free_shuffles(spark: SparkSession) -> None:
    """Let the executors delete the shuffle files of finished jobs now; they go when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def packed(df: DataFrame, **derived: Column) -> DataFrame:
    """All columns as one struct ``row`` beside the derived ones, so that no name can clash."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(n) for n, c in derived.items()])


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row.*")
