"""Stage tables: cut lineage by writing a table to the folder all executors share.

A staged table survives the loss of any executor, is read back with column pruning and filter push-down, and gives
later joins a real size. It is used where a result feeds more than one job.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCAL_ROOTS: dict[str, str] = {}


def stage_root(spark: SparkSession) -> str:
    """Shared folder for stage tables: ``spark.checkpoint.dir``, or a temporary one in local mode only."""
    app = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return f"{root.rstrip('/')}/{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="atlaslex-stage-")
    return _LOCAL_ROOTS[app]


def _path(spark: SparkSession, path: str):
    """A path and the file system that has it."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder."""
    found, system = _path(spark, path)
    return system.exists(found)


def remove_stages(spark: SparkSession) -> None:
    """Remove all stage tables of this application: for jobs, which end with their results written elsewhere."""
    root, system = _path(spark, stage_root(spark))
    system.delete(root, True)


def new_location(spark: SparkSession, name: str) -> str:
    """A fresh path under the stage folder; nothing is ever overwritten."""
    return f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, a query's shuffle files are removed when the query ends and not when the driver collects its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


_OPEN: list[list[str]] = []


@contextmanager
def intermediate_tables(spark: SparkSession) -> Iterator[None]:
    """Stage tables written within it are removed at its end, but for the lasting ones: for work whose result is stored by then."""
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            found, system = _path(spark, path)
            system.delete(found, True)


def stage(df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """Write ``df`` as a stage table and return it read back."""
    path = new_location(df.sparkSession, name)
    if _OPEN and not lasting:
        _OPEN[-1].append(path)
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
