"""Where intermediate tables live: the cluster's shared checkpoint folder.

Long lineages are cut by writing a Parquet table there and reading it back. Unlike a
block kept on an executor, the table survives the loss of any executor, and later
stages get column pruning and filter pushdown on it.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only a local session may do without."""
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        # only where driver and tasks are one process is a folder of this machine shared
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="samesense-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the checkpoint folder that no other call uses."""
    return f"{checkpoint_folder(spark)}/samesense/{label}-{uuid.uuid4().hex}"


# Tables written inside an open ``temporary`` block, innermost last.
_open: list[dict[str, DataFrame]] = []


def store(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` once and return the written table (cuts the lineage); ``options`` go to the writer."""
    path = fresh_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    if _open:
        _open[-1][path] = stored
    return stored


@contextmanager
def temporary() -> Iterator[Callable[[DataFrame | None], DataFrame | None]]:
    """Delete the tables stored inside the block at its end, but for those that are kept.

    Yields ``keep(table)``, which returns its argument. What leaves the block must read kept
    tables only.
    """
    kept: set[str] = set()

    def keep(stored: DataFrame | None) -> DataFrame | None:
        if stored is not None:
            kept.add(stored._stored_at)
        return stored

    _open.append({})
    try:
        yield keep
    finally:
        for path, stored in _open.pop().items():
            if path not in kept:
                discard(stored)
            elif _open:
                _open[-1][path] = stored


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, in whatever store it is."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()).exists(place)


def discard(stored: DataFrame) -> None:
    """Delete a table made by ``store`` that nothing refers to any more."""
    context = stored.sparkSession.sparkContext
    for tables in _open:
        tables.pop(stored._stored_at, None)
    path = context._jvm.org.apache.hadoop.fs.Path(stored._stored_at)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame, least_rows: int = 0) -> DataFrame:
    """Deal a scan over all task slots if it fills only a few of them.

    For work that is heavy per row on a table that is small in bytes. A table with
    enough splits is left as it is, without a shuffle. Meant for plain scans: asking a
    plan with a shuffle in it for its partitions would run that shuffle. With ``least_rows`` only splits
    that hold rows count, as a file of one row group fills one of its splits, and no more
    tasks are asked for than have that many rows each.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if not least_rows:
        return df if df.rdd.getNumPartitions() >= slots else df.repartition(slots)
    filled, rows = df.select(F.spark_partition_id().alias("_part")).agg(F.count_distinct("_part"), F.count(F.lit(1))).first()
    slots = min(slots, rows // least_rows)
    return df if filled >= slots else df.repartition(slots)
