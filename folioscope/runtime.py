"""Session-level helpers shared by all operators: reading tables, cutting lineage, sizing."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers of a session, once, so that they need not have it installed."""
    _shipped(spark.sparkContext.applicationId, spark.sparkContext)


@functools.lru_cache(maxsize=8)
def _shipped(_application: str, context) -> None:
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="folioscope-code-")
    atexit.register(shutil.rmtree, folder, True)
    path = os.path.join(folder, "folioscope_code.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a data directory."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``.

    Only where the session names none and all its tasks run in this process (master ``local``) a temporary
    folder is chosen. On a cluster the executors would each write to a disk of their own, so that is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return _own_dir()


@functools.cache
def _own_dir() -> str:
    path = tempfile.mkdtemp(prefix="folioscope-")
    atexit.register(shutil.rmtree, path, True)
    return f"file://{path}"


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may be gone already
        pass


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table into the shared folder and read it back.

    This cuts the lineage in a way that survives the loss of any executor: the files lie in
    the folder of ``spark.checkpoint.dir``, not in an executor's cache. They are removed when
    the process ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/folioscope/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def power_of_two(least: int, low: int, high: int) -> int:
    """The smallest power of two of at least ``least``, kept between ``low`` and ``high``."""
    n = low
    while n < least and n < high:
        n *= 2
    return n
