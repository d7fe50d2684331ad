"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: A word everywhere in this subpackage: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words as a long (null text: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Cuts the lineage: later jobs, and retries after a lost executor, read the
    files.  The path is new on every call; the folder is the job's scratch.
    """
    path = shared_path(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a narrow table (its files go with the DataFrame)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` for a join that sorts and shuffles both sides, whatever Spark takes their sizes for.

    Spark guesses a table's size from its compressed files, and that of rows made by an
    explode or in Python from the rows they come from.  A table guessed too low would be
    broadcast through the driver.
    """
    return df.hint("merge")
