"""Reading inputs and cutting lineage with written tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from moodline.session import checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one input table, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


MOST_BUCKETS = 100_000
_SCOPES: list[list[str]] = []


@contextmanager
def scope() -> Iterator[list[str]]:
    """Collects the folders of tables that are written meanwhile."""
    _SCOPES.append([])
    try:
        yield _SCOPES[-1]
    finally:
        _SCOPES.pop()


def _folder(spark: SparkSession) -> str:
    path = f"{checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"
    for paths in _SCOPES:
        paths.append(path)
    return path


def remove(spark: SparkSession, *paths: str) -> None:
    """Remove the folders of written tables that nothing reads any more."""
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def bucketed(df: DataFrame, *keys: str, shuffled: bool = True) -> DataFrame:
    """``df`` written in buckets of ``keys``, so that joins by them don't shuffle it again.

    As many buckets as a shuffle has partitions; an external table of the
    session's catalog in the shared checkpoint folder. Not ``shuffled``, each
    task writes a file for every bucket it has rows of.
    """
    spark = df.sparkSession
    path = _folder(spark)
    name = f"llm_{path.rpartition('-')[2]}"
    n = min(int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_BUCKETS)
    ((df.repartition(n, *keys) if shuffled else df).write.bucketBy(n, *keys).format("parquet").option("compression", "zstd").option("path", path)
     .saveAsTable(name))
    return spark.table(name)


def written(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read back.

    The written table survives lost executors and cuts the lineage; only the
    folder named by ``spark.checkpoint.dir`` is used.
    """
    spark = df.sparkSession
    path = _folder(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
