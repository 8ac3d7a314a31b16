"""The warehouse: Parquet tables below one root, and idempotent loads into them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, Observation, SparkSession, functions as F

from orderloom import schemas
from orderloom.operators.absent import held_keys
from orderloom.operators.constraints import with_defaults
from orderloom.operators.firsts import keep_first
from orderloom.sinks import generations, keys


@dataclass(frozen=True)
class TableSpec:
    layout: dict[str, str]
    partition: str | None = None


TABLES = {
    "customers": TableSpec(schemas.CUSTOMERS),
    "products": TableSpec(schemas.PRODUCTS),
    "stores": TableSpec(schemas.STORES),
    "orders": TableSpec(schemas.ORDERS, "order_date"),
    "daily_summary": TableSpec(schemas.DAILY_SUMMARY, "summary_date"),
    "rejects": TableSpec(schemas.REJECTS, "ingest_batch"),
    "batch_metrics": TableSpec(schemas.BATCH_METRICS, "ingest_batch"),
    "touched_dates": TableSpec(schemas.TOUCHED_DATES, "ingest_batch"),
    "open_batches": TableSpec(schemas.OPEN_BATCHES, "ingest_batch"),
    "failed_attempts": TableSpec(schemas.FAILED_ATTEMPTS, "ingest_batch"),
    "master_rejects": TableSpec(schemas.MASTER_REJECTS, "load_label"),
    "order_keys": TableSpec(schemas.ORDER_KEYS, "bucket"),
}


# Partition values that one folder pattern lists.
PATTERN_VALUES = 300


class Warehouse:
    """Tables by name, read with their fixed schema.

    One writer per table at a time: plain Parquet has no transactions between jobs. Run the live and the hourly
    job in turn, or give them separate roots."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def create(self) -> Warehouse:
        """Make the tables that do not exist yet. The index of order ids is made from the orders that there are."""
        for name, spec in TABLES.items():
            if self._exists(name):
                continue
            if name == "order_keys":
                keys.build_keys(self)
            else:
                empty = self.spark.createDataFrame([], schemas.ddl(spec.layout)).write
                (empty.partitionBy(spec.partition) if spec.partition else empty).parquet(self.path(name))
        return self

    def _exists(self, table: str) -> bool:
        try:
            self.read(table)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return False
            raise
        return True

    def read(self, table: str) -> DataFrame:
        rows = self._reader(table).parquet(self.path(table))
        return generations.with_generations(self, table, rows) if table in generations.COMPACTED else rows

    def read_folders(self, table: str, values: list) -> DataFrame:
        """The rows of some partitions, each named by its folder: all of them have to be there."""
        spec = TABLES[table]
        folders = [f"{self.path(table)}/{spec.partition}={value}" for value in values]
        return self._reader(table).option("basePath", self.path(table)).parquet(*folders)

    def read_partitions(self, table: str, values: list) -> DataFrame:
        """The rows of some partitions. Only their folders are listed, however many the table has; many values are
        listed in several patterns, to the same result."""
        found = []
        for begin in range(0, len(values), PATTERN_VALUES):
            part = ",".join(map(str, values[begin:begin + PATTERN_VALUES]))
            folders = f"{self.path(table)}/{TABLES[table].partition}={{{part}}}"
            try:
                found.append(self._reader(table).option("basePath", self.path(table)).parquet(folders))
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
        if not found:
            return self.spark.createDataFrame([], schemas.ddl(TABLES[table].layout))
        return reduce(DataFrame.union, found)

    def _reader(self, table: str) -> DataFrameReader:
        return self.spark.read.schema(schemas.ddl(TABLES[table].layout))

    def _file_system(self, path: str):
        """Hadoop's file system and path object of ``path``, whatever store it is in."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def files(self, table: str, value) -> list[str]:
        """Data files of one partition."""
        system, folder = self._file_system(f"{self.path(table)}/{TABLES[table].partition}={value}")
        found = [f.getPath() for f in system.listStatus(folder)] if system.exists(folder) else []
        return [f.toString() for f in found if not f.getName().startswith(("_", "."))]

    def drop_files(self, paths: list[str]) -> None:
        for path in paths:
            system, place = self._file_system(path)
            system.delete(place, False)

    def drop_partition(self, table: str, value) -> None:
        """Remove one partition and its folder, if it is there."""
        self.drop_folder(f"{self.path(table)}/{TABLES[table].partition}={value}")

    def drop_folder(self, path: str) -> None:
        system, folder = self._file_system(path)
        system.delete(folder, True)

    def names(self, path: str) -> list[str]:
        """What lies in a folder; nothing where there is no folder."""
        system, folder = self._file_system(path)
        return [f.getPath().getName() for f in system.listStatus(folder)] if system.exists(folder) else []

    def read_text(self, path: str) -> str:
        system, place = self._file_system(path)
        stream = system.open(place)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """Write a small file that appears whole or not at all under its name."""
        system, draft = self._file_system(f"{path}.draft")
        stream = system.create(draft, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.rename(f"{path}.draft", path)

    def rename(self, path: str, name: str) -> None:
        system, place = self._file_system(path)
        if not system.rename(place, self._file_system(name)[1]):
            raise OSError(f"{path} could not be renamed")

    def stage(self, label: str, rows: DataFrame) -> DataFrame:
        """``rows`` as files below the root, until :meth:`drop_stage`. Faster to make and to read in part than a cache of
        wide rows, and no executor holds them. Values are not collected to dictionaries, as the files live shortly."""
        rows.write.mode("overwrite").option("parquet.enable.dictionary", "false").parquet(self._stage(label), compression="zstd")
        return self.spark.read.schema(rows.schema).parquet(self._stage(label))

    def drop_stage(self, label: str) -> None:
        self.drop_folder(self._stage(label))

    def _stage(self, label: str) -> str:
        return self.path(f"_staged/{label}")

    def append(self, table: str, rows: DataFrame, written: Observation | None = None) -> None:
        """Add rows, as one commit. Rows of one partition value are brought together, and split again where one
        value has very many, so that neither tiny nor huge files result. ``written`` gets the number of ``rows``,
        counted behind the last shuffle, where a task that is run again is counted once."""
        spec = TABLES[table]
        rows = rows.select(*spec.layout)
        if spec.partition:
            rows = rows.hint("rebalance", spec.partition)
        if written:
            rows = rows.observe(written, F.count(F.lit(1)).alias("rows"))
        writer = rows.write.mode("append")
        (writer.partitionBy(spec.partition) if spec.partition else writer).parquet(self.path(table))

    def replace_partitions(self, table: str, rows: DataFrame) -> None:
        """Overwrite the partitions that occur in ``rows`` and no others; repeating it changes nothing."""
        spec = TABLES[table]
        (rows.select(*spec.layout).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(spec.partition).parquet(self.path(table)))


    def replace_partition(self, table: str, value: str, rows: DataFrame) -> None:
        """Make ``rows`` all that the partition ``value`` holds; without rows it is emptied."""
        spec = TABLES[table]
        rows.select(*(name for name in spec.layout if name != spec.partition)).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").parquet(f"{self.path(table)}/{spec.partition}={value}")


def insert_if_absent(warehouse: Warehouse, table: str, rows: DataFrame, key: str,
                     arrival: list[str]) -> int:
    """Add the rows whose key the table lacks; the first copy of a key wins. Returns the number added. A row without a
    key is an error, and nothing is added then.

    Columns the rows do not have get the table's defaults, or NULL."""
    layout = TABLES[table].layout
    rows = with_defaults(rows.drop(*schemas.STAMPED.get(table, ())), table)
    for name in set(layout) - set(rows.columns):
        rows = rows.withColumn(name, F.lit(None).cast(layout[name]))
    fresh = keep_first(rows, [key], arrival).persist(StorageLevel.MEMORY_AND_DISK)
    held = held_keys(fresh, warehouse.read(table), [key]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if not fresh.filter(F.col(key).isNull()).isEmpty():
            raise ValueError(f"{table}: {key} is null")
        added = fresh.count() - held.count()
        warehouse.append(table, fresh.join(held, key, "left_anti"))
        return added
    finally:
        held.unpersist()
        fresh.unpersist()
