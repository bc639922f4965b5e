"""Parquet tables below a root folder: layers, full refresh, append, keyed upsert, guarded reload, export.

A full refresh writes a fresh folder and then lets the catalog's view of the table show that folder: one statement
switches rows and schema, and until then readers see the old ones. An upsert by year rewrites only the partitions it
touches: the merged rows go to a staging folder first, so the job that replaces the partitions never reads what it
overwrites, and repeating it after a failure gives the same table. An upsert by bucket merges tables whose rows are
bucketed and sorted by the key, so that stored rows are not shuffled.

The catalog holds where a refreshed table lies: on a cluster that is its metastore. Tables that were never refreshed
lie at ``<root>/<layer>/<name>``.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import keyed_upsert
from ..session import run_folder

YEAR = "price_year"


def qualified_name(name: str, layer: str | None = None, default_layer: str = "main") -> str:
    """``layer.name``; a blank layer means the default one."""
    return f"{(layer or '').strip() or default_layer}.{name}"


def bootstrap(spark: SparkSession, layers: Sequence[str] = ("bronze", "silver", "gold")) -> None:
    """Create the namespaces that do not exist yet."""
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")


def create_table(spark: SparkSession, name: str, schema: str, folder: str | None = None) -> None:
    """Create an empty parquet table with a declared schema if it does not exist."""
    location = f" LOCATION '{folder}'" if folder else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet{location}")


def reload_table(spark: SparkSession, name: str, df: DataFrame) -> bool:
    """Replace all rows of a declared table, cast to its columns, unless there are none; tells whether it did."""
    if df.isEmpty():
        return False
    columns = spark.table(name).schema
    df.select(*[F.col(f.name).cast(f.dataType) for f in columns]).write.insertInto(name, overwrite=True)
    return True


def stored(spark: SparkSession, **frames: DataFrame) -> dict[str, DataFrame]:
    """Write frames that several consumers share to the shared folder, side by side, and read them back.

    This cuts their lineage at a table that survives lost executors, instead of computing each frame once
    per consumer.
    """

    @inheritable_thread_target(spark)
    def write(item: tuple[str, DataFrame]) -> tuple[str, DataFrame]:
        label, df = item
        path = run_folder(spark, label)
        df.write.parquet(path)
        return label, spark.read.schema(df.schema).parquet(path)

    with ThreadPoolExecutor(max_workers=len(frames)) as pool:
        return dict(pool.map(write, frames.items()))


def folder_exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


class TableStore:
    """Tables as parquet folders ``<root>/<layer>/<name>`` on storage that all executors share.

    ``namespace`` starts the names of the catalog's databases, one for each layer; by default it comes from the root,
    so that stores do not meet.
    """

    def __init__(self, spark: SparkSession, root: str, namespace: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.namespace = namespace or "store_" + hashlib.md5(self.root.encode()).hexdigest()[:12]

    def view(self, name: str) -> str:
        """The catalog's name of a refreshed table, for SQL."""
        layer, table = name.split(".", 1)
        return f"`{self.namespace}_{layer}`.`{table}`"

    def path(self, name: str) -> str:
        """The folder that holds the table's rows now."""
        if self.spark.catalog.tableExists(self.view(name)):
            shown = self.spark.sql(f"SHOW TBLPROPERTIES {self.view(name)}").filter("key = 'folder'").first()
            if shown:
                return shown["value"]
        layer, table = name.split(".", 1)
        return f"{self.root}/{layer}/{table}"

    def _fresh(self, name: str) -> str:
        layer, table = name.split(".", 1)
        return f"{self.root}/{layer}/{table}@{uuid.uuid4().hex}"

    def _switch(self, name: str, folder: str, rows: str) -> None:
        """Let the catalog show these rows, in one statement."""
        bootstrap(self.spark, [f"{self.namespace}_{name.split('.', 1)[0]}"])
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.view(name)} TBLPROPERTIES ('folder' = '{folder}') AS SELECT * FROM {rows}")

    def read(self, name: str, schema: str | None = None) -> DataFrame:
        """The table; an absent one reads as empty when a schema is given.

        With a schema no file footers are read, and columns that old files lack are NULL.
        """
        reader = self.spark.read.option("mergeSchema", "true") if schema is None else self.spark.read.schema(schema)
        try:
            return reader.parquet(self.path(name))
        except AnalysisException as error:
            if schema is None or not _absent(error):
                raise
            return self.spark.createDataFrame([], schema)

    def replace(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Full refresh. The rows are written once, to a fresh folder, and shown when they are complete. A job that dies
        before leaves the table as it was, and a query may read the table that it replaces."""
        return self.replace_measured(name, df, partition_by)[0]

    def replace_measured(
        self, name: str, df: DataFrame, partition_by: Sequence[str] = (), measures: Mapping[str, Column] | None = None
    ) -> tuple[DataFrame, dict]:
        """Full refresh, and aggregates of the written rows that the writing job itself collects."""
        folder = self._fresh(name)
        written = df.hint("rebalance", *partition_by) if partition_by else df
        seen = Observation(f"written {name}") if measures else None
        if measures:
            # After the exchange: tasks that write count, and of a task that is repeated only one counts.
            written = written.observe(seen, *[m.alias(k) for k, m in measures.items()])
        written.write.partitionBy(*partition_by).parquet(folder)
        self._switch(name, folder, f"parquet.`{folder}`")
        return self.read(name, df.schema), seen.get if measures else {}

    def drop_old(self, name: str) -> int:
        """Delete the folders of earlier refreshes of a table and of refreshes that died; returns their number.

        Readers of an earlier folder that still run fail, so this is for quiet times.
        """
        now, (layer, table) = self.path(name), name.split(".", 1)
        jvm = self.spark._jvm
        above = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{layer}")
        files = above.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        old = [
            f.getPath()
            for f in files.listStatus(above)
            if re.fullmatch(re.escape(table) + "@[0-9a-f]{32}", f.getPath().getName()) and f.getPath().getName() != now.rsplit("/", 1)[-1]
        ]
        for path in old:
            files.delete(path, True)
        return len(old)

    def clone_empty(self, name: str, df: DataFrame) -> DataFrame:
        """Create the table with the columns of ``df`` and no rows, if it is absent."""
        df.limit(0).write.mode("ignore").parquet(self.path(name))
        return self.read(name)

    def append(self, name: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.path(name))

    def replace_part(self, name: str, part: str, df: DataFrame) -> None:
        """Overwrite one ``key=value`` folder of a table, so that repeating a load does not add rows twice."""
        df.write.mode("overwrite").parquet(f"{self.path(name)}/{part}")

    def reload(self, name: str, df: DataFrame) -> bool:
        """Replace all rows unless there are none to load; tells whether it did."""
        if df.isEmpty():
            return False
        self.replace(name, df)
        return True

    def upsert(
        self,
        name: str,
        incoming: DataFrame,
        keys: Sequence[str],
        date_col: str = "price_date",
        year: Column | None = None,
    ) -> bool:
        """Merge by key into a table partitioned by year; the key must include the date column.

        ``year`` tells the year of a date column that holds text. Only years present in the load are read
        and rewritten. An empty load changes nothing. Columns the table does not have are added, and are
        NULL in older files.
        """
        if date_col not in keys:
            raise ValueError(f"keys must include {date_col}")
        year = F.year(date_col) if year is None else year
        # One value per calendar year.
        years = [r[0] for r in incoming.select(year).distinct().collect()]
        if not years:
            return False
        try:
            existing = self.read(name)
        except AnalysisException as error:
            if not _absent(error):
                raise
            self._write_years(incoming.withColumn(YEAR, year), name)
            return True
        if YEAR in existing.columns:
            existing = existing.filter(_in_years(F.col(YEAR), years)).drop(YEAR)
        staged = run_folder(self.spark, "staged")
        keyed_upsert(existing, incoming, keys).withColumn(YEAR, year).write.parquet(staged)
        self._write_years(self.spark.read.parquet(staged), name)
        return True

    def bucketed(self, name: str, df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
        """Full refresh of a table whose rows are bucketed and sorted by key, one file for each bucket."""
        layer, table = name.split(".", 1)
        folder = self._fresh(name)
        held = f"`{self.namespace}_{layer}`.`{table}_{folder[-32:]}`"
        bootstrap(self.spark, [f"{self.namespace}_{layer}"])
        df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", folder).saveAsTable(held)
        self._switch(name, folder, held)
        return self.spark.table(self.view(name))

    def merged_buckets(self, name: str, incoming: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
        """The merge of a bucketed table with incoming rows: only the incoming rows are shuffled, to the buckets."""
        arriving = incoming.repartition(buckets, *keys)
        if not self.spark.catalog.tableExists(self.view(name)):
            return arriving
        return keyed_upsert(self.spark.table(self.view(name)), arriving, keys, in_place=True)

    def upsert_bucketed(self, name: str, incoming: DataFrame, keys: Sequence[str], buckets: int = 200) -> DataFrame:
        """Merge by any keys into a bucketed table. Each bucket is read, merged and written by one task, and the old
        buckets stay until the new ones are complete; repeating a load changes nothing."""
        return self.bucketed(name, self.merged_buckets(name, incoming, keys, buckets), keys, buckets)

    def _write_years(self, df: DataFrame, name: str) -> None:
        # Rebalancing splits a large year over several tasks and files, and packs small ones.
        (
            df.hint("rebalance", YEAR)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(YEAR)
            .parquet(self.path(name))
        )

    def exists(self, name: str) -> bool:
        return folder_exists(self.spark, self.path(name))

    def count(self, name: str) -> int:
        return self.read(name).count()

    def export_csv(self, df: DataFrame, path: str) -> None:
        df.write.mode("overwrite").option("header", True).csv(path)


def _absent(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def _in_years(column, years):
    known = [y for y in years if y is not None]
    hit = column.isin(known) if known else F.lit(False)
    return (hit | column.isNull()) if None in years else hit
