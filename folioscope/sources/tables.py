"""Tables in and out: vector tables by project, graph statements, JSON lines, manifests.

There is no table format with its own upsert here, so a project is replaced by overwriting its
partition: other projects' files are not touched.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PROJECT = re.compile(r"[\w\-. 　-鿿豈-﫿]+")


def checked_id(project: str) -> str:
    """A project id that may stand in a path or a filter."""
    if not project or not _PROJECT.fullmatch(project):
        raise ValueError(f"not a project id: {project!r}")
    return project


def write_vectors(rows: DataFrame, path: str, *, project: str | None, replace: bool = False, dims: int | None = None) -> None:
    """Append a project's rows, or replace them. Rows without a full vector are left out (count them with ``failed``).

    Replacing needs a project; appending to a project that is there already needs ``replace``."""
    if replace and not project:
        raise ValueError("replace needs a project")
    spark = rows.sparkSession
    if project:
        checked_id(project)
        rows = rows.filter(F.col("project_id") == project)
        if not replace and exists(spark, path) and not read_vectors(spark, path, project=project).isEmpty():
            raise ValueError(f"{project} has rows already; use replace")
    good = rows.filter(F.col("embedding").isNotNull() & (F.size("embedding") == dims if dims else F.lit(True)))
    writer = good.write.partitionBy("project_id").option("partitionOverwriteMode", "dynamic")
    writer.mode("overwrite" if replace else "append").parquet(path)


def failed(rows: DataFrame, dims: int) -> int:
    return rows.filter(F.col("embedding").isNull() | (F.size("embedding") != dims)).count()


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_vectors(spark: SparkSession, path: str, *, project: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of a project: only its partition is read, and only the columns asked for. Columns added later are null in older files."""
    df = spark.read.option("mergeSchema", True).parquet(path)
    if project:
        df = df.filter(F.col("project_id") == checked_id(project))
    return df.select(*columns) if columns else df


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_statements(statements: DataFrame, path: str) -> None:
    """One statement a line, nodes before edges as they come."""
    statements.select("statement").write.mode("overwrite").text(path)


def manifest(files: DataFrame) -> DataFrame:
    """One row per project: a JSON text of counts by type, role and state, and the bytes."""
    count = lambda c: files.groupBy("project_id", F.coalesce(F.when(F.col(c) != "", F.col(c)), F.lit("unclassified")).alias("k")).count().groupBy("project_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "count")))).alias(c))
    total = files.groupBy("project_id").agg(F.count("*").alias("files"), F.sum("size_bytes").alias("total_size_bytes"))
    out = total.join(count("source_type"), "project_id").join(count("document_role"), "project_id").join(count("parser_type"), "project_id")
    return out.select("project_id", F.to_json(F.struct(*[c for c in out.columns])).alias("manifest"))
