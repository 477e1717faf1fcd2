"""Find and read tables stored as ``<warehouse>/<table>/data``."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.tables import layout, noted_columns
from tidemark.session import folder_exists, hadoop_path


def discover_tables(spark: SparkSession, warehouse: str) -> list[str]:
    """Sorted names of the sub-folders that hold a ``data`` folder."""
    root, fs = hadoop_path(spark, warehouse)
    if not fs.exists(root):
        raise FileNotFoundError(f"no warehouse at {warehouse}")
    folders = [s.getPath().toString() for s in fs.listStatus(root) if s.isDirectory()]
    names = sorted(f.rpartition("/")[2] for f in folders if folder_exists(spark, f"{f}/data"))
    if not names:
        raise FileNotFoundError(f"no tables under {warehouse}")
    return names


def load_table(spark: SparkSession, warehouse: str, name: str, recursive: bool = False) -> DataFrame:
    """All Parquet files of one table; hidden and other files are skipped.

    Partition folders become columns. Tables that this library wrote have their columns noted beside the
    files, and show those of their contract. Otherwise files of an evolved table may differ, and the columns
    of all of them are kept. ``recursive`` reads any nesting instead, ignoring folder names.
    """
    folder = f"{warehouse.rstrip('/')}/{name}/data"
    if not folder_exists(spark, folder):
        raise FileNotFoundError(f"no data folder at {folder}")
    noted = None if recursive else noted_columns(spark, folder)
    if noted:
        schema, unseen = noted
        rows = spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(folder)
        return rows.drop(*unseen)
    try:
        reader = spark.read.option("pathGlobFilter", "*.parquet").option("mergeSchema", True)
        return reader.option("recursiveFileLookup", str(recursive).lower()).parquet(folder)
    except AnalysisException as error:
        raise FileNotFoundError(f"no Parquet files under {folder}") from error


def register_catalog(spark: SparkSession, database: str, names: list[str]) -> list[str]:
    """Temporary view in place of each catalog table that has columns which readers do not ask for."""
    registered = []
    for name in names:
        unseen = layout(spark, f"{database}.{name}").unseen
        if unseen:
            spark.table(f"{database}.{name}").drop(*unseen).createOrReplaceTempView(name)
            registered.append(name)
    return registered


def register_tables(
    spark: SparkSession, warehouse: str, names: list[str] | None = None
) -> list[str]:
    """Temporary view per table, for the named tables or for all that hold files."""
    registered = []
    for name in names or discover_tables(spark, warehouse):
        try:
            load_table(spark, warehouse, name).createOrReplaceTempView(name)
        except FileNotFoundError:
            if names:
                raise
        else:
            registered.append(name)
    if not registered:
        raise FileNotFoundError(f"no Parquet files in any table under {warehouse}")
    return registered
