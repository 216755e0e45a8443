"""Streams of files and events, beside the batch runs.

Checkpoints lie in the folder all executors share. Results of batches are idempotent: a batch that runs
again overwrites what it wrote.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.runtime import shared_dir


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A parquet table as a stream, in its stored schema."""
    path = f"{sf_dir}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(path if _is_dir(spark, path) else _glob(sf_dir, name))


def _is_dir(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def _glob(sf_dir: str, name: str) -> str:
    """A single file is read as a stream through a pattern that only it fits."""
    return f"{sf_dir}/{name[:-1]}[{name[-1]}].parquet"


def windowed_counts(events: DataFrame, *, time: str, by: str, size: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts in tumbling windows; events later than ``late`` behind the newest are dropped by the watermark."""
    e = events.withColumn("t_", F.col(time).cast("timestamp")).withWatermark("t_", late)
    return e.groupBy(F.window("t_", size).alias("w"), by).agg(F.count("*").alias("events")).select(F.col("w.start").alias("begin"), by, "events")


def once_each(stream: DataFrame, *, key: str, time: str, late: str = "7 days") -> DataFrame:
    """Rows delivered again within the watermark are dropped."""
    return stream.withColumn("t_", F.col(time).cast("timestamp")).withWatermark("t_", late).dropDuplicatesWithinWatermark([key]).drop("t_")


def run_once(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """All that the source holds now, run through the stream and read back as a table."""
    spark = stream.sparkSession
    base = f"{shared_dir(spark)}/folioscope/stream-{name}-{uuid.uuid4().hex}"
    out, schema = f"{base}/out", stream.schema

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/state").foreachBatch(write).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(out)


def ingest_documents(stream: DataFrame, path: str, transform, checkpoint: str):
    """A running query: every batch of documents is split, embedded and appended to the vector table at ``path``."""

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "project_id").parquet(path)

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start()
