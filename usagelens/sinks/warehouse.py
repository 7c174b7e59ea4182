"""Warehouse sink: the declared schema is a contract, writes replace.

The original jobs truncate the target table and create it when absent, so a
job that fails half-way leaves neither the old rows nor the new ones.  Here
the old rows stay readable until the new ones are complete:

* a catalogue table's rows go to a fresh folder; when they are all written, the
  table's location is switched to it, and the folder it pointed at is removed;
* a plain folder's rows go to a fresh folder beside it, which then takes its
  place (the old one is set aside first and put back should that fail).

A failed job leaves the fresh folder at most, which no reader looks at.
Within the write, Spark's file commit protocol publishes a task's output
only when the task commits, so retries and lost executors are safe.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from usagelens.sinks.folders import exists, move, remove


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Reorder/cast columns to the declared sink schema.  A missing column
    fails here, before any data moves (``DataFrame.to`` alone would fill
    a missing nullable column with nulls)."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} required by the sink schema are missing")
    return df.to(schema)


def write_table(df: DataFrame, schema: StructType | None = None, *, path: str | None = None,
                table: str | None = None, mode: str = "overwrite",
                num_files: int | None = None) -> None:
    """Write ``df`` to a Parquet folder (``path``) or a catalog table
    (``table``, its folders kept under ``path`` if given).  ``num_files``
    coalesces small results (the ranked products have at most k rows)."""
    if path is None and table is None:
        raise ValueError("give path= or table=")
    if schema is not None:
        df = conform(df, schema)
    if num_files is not None:
        df = df.coalesce(num_files)
    if table is not None:
        _write_catalogue(df, table, path, mode)
    elif mode == "overwrite":
        _replace_folder(df, path.rstrip("/"))
    else:
        df.write.mode(mode).parquet(path)


def _replace_folder(df: DataFrame, path: str) -> None:
    spark, run = df.sparkSession, uuid.uuid4().hex
    fresh, old = f"{path}.new-{run}", f"{path}.old-{run}"
    df.write.parquet(fresh)
    had = exists(spark, path)
    if had:
        move(spark, path, old)
    try:
        move(spark, fresh, path)
    except Exception:
        if had:
            move(spark, old, path)
        raise
    if had:
        remove(spark, old)


def _location(spark: SparkSession, table: str) -> str:
    detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
    return detail["Location"]


def _write_catalogue(df: DataFrame, table: str, root: str | None, mode: str) -> None:
    spark = df.sparkSession
    if mode != "overwrite":
        df.write.mode(mode).format("parquet").saveAsTable(table)
        return
    if root is None:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table}.versions"
    fresh = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(fresh)
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=fresh, source="parquet")
        return
    current = spark.table(table).schema
    if [(f.name, f.dataType) for f in current] != [(f.name, f.dataType) for f in df.schema]:
        raise ValueError(f"table {table} has other columns: {current.simpleString()}; {fresh} holds the new rows")
    old = _location(spark, table)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{fresh}'")
    spark.catalog.refreshTable(table)
    remove(spark, old)


def read_table(spark: SparkSession, schema: StructType | None = None, *,
               path: str | None = None, table: str | None = None) -> DataFrame:
    if table is not None:
        df = spark.read.table(table)
    else:
        reader = spark.read.format("parquet")
        if schema is not None:
            reader = reader.schema(schema)
        df = reader.load(path)
    return conform(df, schema) if schema is not None else df
