"""Sinks: tables by format, partitioned event files, model summaries.

Nothing is collected to the driver: every writer is a distributed
``DataFrameWriter`` (or the Arrow data source writer).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from .arrow import FORMAT as ARROW_FORMAT
from .arrow import register_arrow


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    compression: str | None = None,
    partition_by: list[str] | None = None,
    header: bool = True,
) -> None:
    """Write a table: parquet (default zstd), csv with header, json, arrow."""
    fmt = fmt.lower()
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "parquet":
        w.option("compression", compression or "zstd").parquet(path)
    elif fmt == "csv":
        w = w.option("header", header)
        if compression:
            w = w.option("compression", compression)
        w.csv(path)
    elif fmt == "json":
        if compression:
            w = w.option("compression", compression)
        w.json(path)
    elif fmt == "arrow":
        register_arrow(df.sparkSession)
        w = df.write.format(ARROW_FORMAT).mode(mode)
        if compression:
            w = w.option("compression", compression)
        w.save(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def checkpoint_json(df: DataFrame, path: str) -> DataFrame:
    """Write typed JSON lines and read them back with the same schema (a re-readable checkpoint)."""
    df.write.mode("overwrite").json(path)
    return df.sparkSession.read.schema(df.schema).json(path)


def write_events(df: DataFrame, path: str, compression: str = "zstd", partitions: int | None = None) -> None:
    """One folder per ticker and day (``ticker=<t>/date=<d>``), so readers prune partitions.

    Rows are range-partitioned on (ticker, date, ts): one hot ticker-day is
    cut into several tasks (several files in its folder) instead of one.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["ticker", "date"] + (["ts"] if "ts" in df.columns else [])
    df.repartitionByRange(n, *keys).write.mode("overwrite").partitionBy("ticker", "date").option(
        "compression", compression
    ).parquet(path)


SUMMARIES = ("coef", "fit", "holdout", "final")
_VERSIONS = "_versions"


def _store(spark: SparkSession, path: str):
    """(the store that holds ``path``, ``path`` as the store names it)."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions stored at ``path``."""
    store, where = _store(spark, f"{path.rstrip('/')}/{_VERSIONS}")
    return sorted(int(f.getPath().getName()) for f in store.listStatus(where)) if store.exists(where) else []


def write_summaries(spark: SparkSession, result, path: str) -> int:
    """All results of a staged regression as one version; returns its number.

    Coefficients and fit statistics (partitioned by stage), hold-out errors with
    the number of dropped terms, and the final table.  The tables are written to a
    folder of their own first; a marker file, created in one step and never
    overwritten, makes them the current version.  A reader sees all tables of
    one version; a failed or concurrent writer leaves the others' as they are.
    """
    root, folder = path.rstrip("/"), f"data-{uuid.uuid4().hex}"
    result.coef_df(spark).write.partitionBy("stage").parquet(f"{root}/{folder}/coef")
    result.fit_df(spark).write.partitionBy("stage").parquet(f"{root}/{folder}/fit")
    result.holdout_df(spark).write.parquet(f"{root}/{folder}/holdout")
    result.final_table.write.option("compression", "zstd").parquet(f"{root}/{folder}/final")
    number = max(versions(spark, root), default=0) + 1
    store, marks = _store(spark, f"{root}/{_VERSIONS}")
    store.mkdirs(marks)
    while True:
        store, mark = _store(spark, f"{root}/{_VERSIONS}/{number}")
        _, draft = _store(spark, f"{root}/{folder}/_name")
        with_name = store.create(draft, True)
        with_name.write(folder.encode())
        with_name.close()
        if not store.exists(mark) and store.rename(draft, mark):
            return number
        number += 1


def read_summaries(spark: SparkSession, path: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of a version (default: the last complete one) by name."""
    root, found = path.rstrip("/"), versions(spark, path)
    if not found or (version is not None and version not in found):
        raise FileNotFoundError(f"no such version at {path}")
    name = spark.read.text(f"{root}/{_VERSIONS}/{version or found[-1]}").first()[0]
    return {table: spark.read.parquet(f"{root}/{name}/{table}") for table in SUMMARIES}
