"""Side inputs and results on storage: CSV, Parquet and catalog tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillcast.functions.lineage import materialise


def read_side_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A CSV file with header, read with a declared schema (no inference pass)."""
    return spark.read.option("header", True).schema(schema).csv(path)


def write_csv_extract(df: DataFrame, path: str) -> None:
    """A table as CSV with header; as many part files as tasks, never one writer."""
    df.write.mode("overwrite").option("header", True).csv(path)


# ---- versioned tables: a folder per version, and an empty file per switch whose name says which one holds

def _store(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), spark.sparkContext._jvm.org.apache.hadoop.fs.Path


def versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of the finished versions of a table, oldest first."""
    fs, place = _store(spark, path)
    log = place(f"{path}/_switches")
    if not fs.exists(log):
        return []
    names = sorted(f.getPath().getName() for f in fs.listStatus(log))
    return [f"{path}/version-{n.partition('-')[2]}" for n in names]


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The table as the last finished run left it. A reader that has begun goes on reading its version."""
    done = versions(spark, path)
    if not done:
        raise FileNotFoundError(f"no finished version in {path}")
    return spark.read.parquet(done[-1])


def full_refresh(df: DataFrame, path: str, partition_by: list[str] = (), keep: int = 2) -> DataFrame:
    """Replace a table by this result and read it back. The result may read the table itself.

    It is written to a folder of its own; only when that is complete is the pointer switched, by creating one empty file, whose
    name says all. A run that fails leaves the old version in force; readers of the old one finish, as the last ``keep``
    versions stay. Of two runs that finish together the greater name holds."""
    spark = df.sparkSession
    name = uuid.uuid4().hex
    df.write.partitionBy(*partition_by).parquet(f"{path}/version-{name}")
    fs, place = _store(spark, path)
    fs.create(place(f"{path}/_switches/{len(versions(spark, path)) + _dropped(spark, path):010d}-{name}"), False).close()
    _drop_versions(spark, path, keep)
    return read_current(spark, path)


def _dropped(spark: SparkSession, path: str) -> int:
    """Number of the next switch less those still listed."""
    fs, place = _store(spark, path)
    log = place(f"{path}/_switches")
    names = sorted(f.getPath().getName() for f in fs.listStatus(log)) if fs.exists(log) else []
    return int(names[-1].partition("-")[0]) + 1 - len(names) if names else 0


def _drop_versions(spark: SparkSession, path: str, keep: int) -> None:
    """Delete what is older than the last ``keep`` versions: the switch first, then its folder."""
    fs, place = _store(spark, path)
    names = sorted(f.getPath().getName() for f in fs.listStatus(place(f"{path}/_switches")))
    for name in names[:-keep] if keep else []:
        fs.delete(place(f"{path}/_switches/{name}"), False)
        fs.delete(place(f"{path}/version-{name.partition('-')[2]}"), True)


def append_increment(df: DataFrame, path: str, partition_by: list[str], keys: list[str] | None = None) -> None:
    """Write this run's rows: running twice is harmless, and rows of other keys are never lost.

    With ``keys`` a row replaces the one of the same key, and the other rows of its partition stay. Without, whole
    partitions are replaced, which is right only if the run holds them whole. Partitions that are not touched are not read."""
    rows = df
    spark = df.sparkSession
    fs, place = _store(spark, path)
    if keys is not None and fs.exists(place(path)):
        old = spark.read.schema(df.schema).parquet(path)
        touched = old.join(df.select(*partition_by).distinct(), partition_by, "left_semi")
        new = df.select(*[F.col(c).alias(f"_new_{c}") for c in keys]).distinct()
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in keys])
        rows = materialise(df.unionByName(touched.join(new, same, "left_anti")))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def save_table(df: DataFrame, name: str) -> None:
    """Replace the catalog's ``name`` by this result: a versioned table in the warehouse behind a view, so that the switch is
    one change of the catalog and the result may read what it replaces."""
    spark = df.sparkSession
    path = f"{spark.conf.get('spark.sql.warehouse.dir')}/{name}.versions"
    full_refresh(df, path)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{versions(spark, path)[-1]}`")


def load_if_missing(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The named table, created from ``make`` only if the catalog does not have it."""
    if not spark.catalog.tableExists(name):
        save_table(make(), name)
    return spark.table(name)
