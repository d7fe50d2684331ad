"""Session helpers.

Everything in the library takes a ``SparkSession`` from the caller; these
helpers only cover the two settings the library relies on (UTC session
zone, a shared checkpoint folder) and a local session for tests.
"""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "tidewater") -> SparkSession:
    """A local session for tests and the benchmark (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be configured, on shared storage; it is only
    filled in here when the master is local (tests), where one machine runs all.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def staged(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back (deleted when the session ends).

    Later jobs scan only the columns they use, and retries after a lost executor
    start from the files.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    df.write.option("compression", "zstd").parquet(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def drop_finished_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs whose plans nobody holds any more.

    Its cleaner acts when the driver collects garbage (every half hour if
    memory never runs short), so a finished large write would keep its shuffle
    on disk beside everything that follows.  Plans that Python's own cycles hold go first.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop_files(spark: SparkSession, path: str) -> None:
    """Delete a folder of scratch files that nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
