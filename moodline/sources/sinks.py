"""Sinks: versioned full-refresh tables (S5), merge sink (S6), append-only
JSON (S7), dashboard extracts (S10), layer namespaces (S9).

Full refresh: ``<root>/<layer>/<table>/v<NNNNNNNNNN>/`` Parquet. A version is
committed when Spark's job commit writes its ``_SUCCESS`` marker; readers take
the newest committed one. A refresh never touches the version it reads, so a
failed or killed job leaves the previous version current and a rerun starts
clean.

Merge targets are one version that Spark partitions by a hash bucket of the
key. The partition column's name holds the number of buckets and the keys
(``_bucket_32__ticket_id``), so the folder describes itself and the layout it
was made with is the one that later merges follow. A merge reads only the
partitions its batch touches and replaces only those, by ``insertInto`` with
dynamic partition overwrite into an external table of the session's catalog
(one database per layer, S9). AQE's rebalancing sizes the files of each
partition by their measured bytes, so a bucket of any size is written by as
many tasks as it needs.

Dynamic overwrite replaces partition folders one after another when the job
commits. The merged rows are therefore written to ``_pending`` first and
inserted from there; a merge that finds a committed ``_pending`` of a killed
one inserts it again (the same rows into the same partitions) before it
starts. One writer per table at a time (runs of one pipeline are serialised
by the scheduler); a reader during the commit may see partitions of both
states.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from moodline.operators.merge import merge_by_key

LAYERS = ("raw_zone", "staging", "core", "enrichment", "dashboard")  # S9
VERSION_PREFIX = "v"
VERSION_DIGITS = 10
BUCKET_PREFIX = "_bucket_"
PENDING = "_pending"
DEFAULT_BUCKETS = 32
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def bucket_column(keys: Sequence[str], buckets: int) -> str:
    return f"{BUCKET_PREFIX}{buckets}__{'__'.join(keys)}"


class TableStore:
    """Tables under one root (local path, HDFS or object store URI).

    ``merge_buckets``: bucket count of merge targets created from now on
    (None: plain, each merge is a full refresh).
    """

    def __init__(self, spark: SparkSession, root: str, merge_buckets: int | None = DEFAULT_BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.merge_buckets = merge_buckets

    # -- paths ---------------------------------------------------------
    def table_path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def _folders(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()] if fs.exists(p) else []

    def _numbers(self, base: str) -> list[int]:
        return sorted(int(n[1:]) for n in self._folders(base) if n.startswith(VERSION_PREFIX) and n[1:].isdigit())

    @staticmethod
    def _at(base_path: str, number: int) -> str:
        return f"{base_path}/{VERSION_PREFIX}{number:0{VERSION_DIGITS}d}"

    def versions(self, layer: str, table: str) -> list[str]:
        """Committed versions, oldest first."""
        base = self.table_path(layer, table)
        return [path for n in self._numbers(base) if self._exists(f"{(path := self._at(base, n))}/_SUCCESS")]

    def current(self, layer: str, table: str) -> str | None:
        v = self.versions(layer, table)
        return v[-1] if v else None

    def _next(self, layer: str, table: str) -> str:
        base = self.table_path(layer, table)
        return self._at(base, max(self._numbers(base), default=-1) + 1)

    def _partitioning(self, path: str | None) -> str | None:
        """Partition column of a version, by its folders."""
        return next((n.partition("=")[0] for n in self._folders(path) if "=" in n), None) if path else None

    def _bucketing(self, path: str | None) -> tuple[str, int, list[str]] | None:
        """Partition column, bucket count and keys of a merge target, by its folders."""
        column = self._partitioning(path)
        if column is None or not column.startswith(BUCKET_PREFIX):
            return None
        buckets, *keys = column.removeprefix(BUCKET_PREFIX).split("__")
        return column, int(buckets), keys

    # -- catalog -------------------------------------------------------
    def database(self, layer: str) -> str:
        """The layer's database in the session's catalog (S9); stores with other roots have others."""
        name = f"{layer}_{zlib.crc32(self.root.encode()):08x}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{self.root}/{layer}'")
        return name

    def catalog_table(self, layer: str, table: str) -> str | None:
        """Name of a partitioned table as an external table of the session's catalog, registered where it isn't yet.

        A catalog that outlives the session keeps it; else the folder's files tell its columns.
        """
        path = self.current(layer, table)
        column = self._partitioning(path)
        if column is None:
            return None
        name = f"{self.database(layer)}.`{table}`"
        if self.spark.catalog.tableExists(name.replace("`", "")):
            about = {r.col_name: r.data_type for r in self.spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
            if about.get("Location", "").rstrip("/").endswith(path.rpartition(":")[2]):
                return name
            self.spark.sql(f"DROP TABLE {name}")  # external: its files stay
        fields = self.spark.read.option("mergeSchema", True).parquet(path).schema.fields
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (`{column}`) LOCATION '{path}'")
        self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        return name

    # -- read / write --------------------------------------------------
    def read(self, layer: str, table: str, schema: StructType | None = None) -> DataFrame | None:
        """Current version, or None if the table has none yet."""
        path = self.current(layer, table)
        if path is None:
            return None if schema is None else self.spark.createDataFrame([], schema)
        found = self._bucketing(path)
        if found is not None:
            # The catalog knows the columns that later batches added; the folder is listed anew.
            known = self.spark.table(self.catalog_table(layer, table)).schema
            rows = self.spark.read.schema(known).parquet(path).drop(found[0])
            return rows if schema is None else rows.select(*[
                F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
        reader = self.spark.read
        return (reader.schema(schema) if schema is not None else reader).parquet(path)

    def overwrite(self, df: DataFrame, layer: str, table: str,
                  partition_by: Sequence[str] = ()) -> str:
        """Full refresh into a new version; returns its path."""
        path = self._next(layer, table)
        writer = df.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        return path

    def overwrite_bucketed(self, df: DataFrame, layer: str, table: str, key: str, buckets: int = DEFAULT_BUCKETS) -> DataFrame:
        """S5 as a bucketed and sorted table of the session's catalog, whose rows are read without an exchange by key.

        Dedupes and merges by ``key`` (W1, W2, J2) then need no shuffle. Files
        are a new version like any other and can be read by path; what tells
        Spark of the buckets is the catalog, so the table that it knows is
        returned.
        """
        path = self._next(layer, table)
        name = f"{self.database(layer)}.`{table}_by_{key}`"
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: the last version's files stay
        (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet").option("path", path)
         .saveAsTable(name.replace("`", "")))
        return self.spark.table(name)

    def append(self, df: DataFrame, layer: str, table: str) -> str:
        """Add rows to the first and only version of a log table."""
        path = self._at(self.table_path(layer, table), 0)
        df.write.mode("append").parquet(path)
        return path

    def merge(self, batch: DataFrame, layer: str, table: str, key: str | Sequence[str],
              order: Sequence[Column] | None = None, newest: bool = False, empty: bool | None = None) -> str:
        """Merge ``batch`` into the current version; returns the version's path.

        The batch is read twice (its buckets, then its rows), so it should be
        staged. A plain table is dealt to buckets whole, as a new version, by
        its first merge with ``merge_buckets``; an empty one stays plain. Who
        knows whether the batch is ``empty`` spares the job that asks.
        """
        keys = [key] if isinstance(key, str) else list(key)
        path = self.current(layer, table)
        found = self._bucketing(path)
        if found is not None:
            if found[2] != keys:
                raise ValueError(f"{layer}.{table} is bucketed by {found[2]}, not by {keys}")
            return self._merge_partitions(batch, layer, table, path, *found, order, newest)
        merged = merge_by_key(self.read(layer, table), batch, keys, order, newest)
        if not self.merge_buckets or (path is None and (batch.isEmpty() if empty is None else empty)):
            return self.overwrite(merged, layer, table)
        column = bucket_column(keys, self.merge_buckets)
        dealt = merged.withColumn(column, _bucket(keys, self.merge_buckets)).hint("rebalance", F.col(column))
        return self.overwrite(dealt, layer, table, [column])

    def _merge_partitions(self, batch: DataFrame, layer: str, table: str, path: str, column: str, buckets: int,
                          keys: list[str], order: Sequence[Column] | None, newest: bool) -> str:
        self._insert_pending(layer, table)
        own = _bucket(keys, buckets)
        touched = [r[0] for r in batch.select(own.alias("b")).distinct().collect()]  # at most ``buckets`` numbers
        if not touched:
            return path
        known = self.spark.table(self.catalog_table(layer, table)).schema
        target = self.spark.read.schema(known).parquet(path).where(F.col(column).isin(touched))
        merged = merge_by_key(target, batch.withColumn(column, own), keys, order, newest)
        self._replace(merged, layer, table, column)
        return path

    def _replace(self, rows: DataFrame, layer: str, table: str, column: str) -> None:
        pending = f"{self.table_path(layer, table)}/{PENDING}"
        rows.hint("rebalance", F.col(column)).write.mode("overwrite").partitionBy(column).parquet(pending)
        self._insert_pending(layer, table, rows.schema)

    def replace_partitions(self, rows: DataFrame, layer: str, table: str, column: str) -> None:
        """Replace the partitions of ``column`` that ``rows`` has; others stay. ``rows`` may read the same table.

        A later call first finishes one that was killed while it committed (:meth:`finish`).
        """
        path = self.current(layer, table)
        if path is None:
            self.overwrite(rows.hint("rebalance", F.col(column)), layer, table, [column])
        elif self._partitioning(path) is None:  # an empty first version has no partitions yet
            self.overwrite(rows.unionByName(self.read(layer, table), allowMissingColumns=True), layer, table, [column])
        else:
            self._replace(rows, layer, table, column)

    def finish(self, layer: str, table: str) -> None:
        """Insert what a killed replacement had still to commit, if anything."""
        self._insert_pending(layer, table)

    def _insert_pending(self, layer: str, table: str, schema: StructType | None = None) -> None:
        """Insert the merged rows of this merge, or of one that was killed, into their partitions."""
        pending = f"{self.table_path(layer, table)}/{PENDING}"
        fs, at = self._fs(pending)
        if not self._exists(f"{pending}/_SUCCESS"):
            return
        name = self.catalog_table(layer, table)
        reader = self.spark.read.schema(schema) if schema is not None else self.spark.read.option("mergeSchema", True)
        rows = reader.parquet(pending)
        have = self.spark.table(name).columns
        added = [f for f in rows.schema if f.name not in have]
        if added:
            self.spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in added)})")
        columns = self.spark.table(name).columns
        mode = self.spark.conf.get(OVERWRITE_MODE)
        self.spark.conf.set(OVERWRITE_MODE, "dynamic")
        try:
            rows.select(*[F.col(f"`{c}`") for c in columns]).write.insertInto(name, overwrite=True)
        finally:
            self.spark.conf.set(OVERWRITE_MODE, mode)
        fs.delete(at, True)

    def remove(self, path: str) -> None:
        """Remove a staged folder that nothing reads any more."""
        fs, p = self._fs(path)
        fs.delete(p, True)

    def expire(self, layer: str, table: str, keep: int = 3) -> list[str]:
        """Retention: remove all but the newest ``keep`` versions and, below the newest, those never committed."""
        base, versions = self.table_path(layer, table), self.versions(layer, table)
        if not versions:
            return []
        stays = set(versions[-max(1, keep):])
        goes = [path for n in self._numbers(base) if (path := self._at(base, n)) not in stays and path < versions[-1]]
        for path in goes:
            self.remove(path)
        return goes


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def append_json(df: DataFrame, path: str) -> None:
    """Append-only JSON lines (audit events)."""
    df.write.mode("append").json(path)


def export_extract(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Serve a dashboard table as JSON or CSV files.

    Dashboard tables are bounded (top-k rows; regions x days x 24 hours),
    so the extract is small whatever the input size.
    """
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "json":
        writer.json(path)
    else:
        raise ValueError(f"unsupported extract format {fmt!r}")
