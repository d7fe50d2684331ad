"""Page files arriving over time, read with Structured Streaming.

The source pipeline collects API pages into JSON-lines files and processes
them in batch.  The same projections run incrementally here: a file-stream
source with the fixed page schema (no inference on a stream), the post and
label operators of the batch path, and a file sink whose progress is kept in
the checkpoint location (so a restarted job resumes where it stopped).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import labels, posts
from ..schemas import page_schema
from ..session import ensure_checkpoint_dir


def read_page_stream(spark: SparkSession, folder: str, max_files_per_trigger: int = 100) -> DataFrame:
    """Streaming DataFrame of pages from JSON-lines files dropped into ``folder``."""
    return (
        spark.readStream.schema(page_schema())
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .json(folder)
    )


def post_metrics_stream(pages: DataFrame) -> DataFrame:
    """Flat per-post counters (id, author, time, five counters) with the page's retrieval time."""
    flat = posts.posts(pages, keep=("__twarc",))
    return flat.select(
        F.col("__twarc.retrieved_at").alias("retrieved_at"),
        "id", "author_id", "created_at",
        *[F.col(f"public_metrics.{c}").alias(c) for c in posts.METRIC_COLUMNS],
    )


def running_label_counts(pages: DataFrame) -> DataFrame:
    """Posts per label over everything received so far (stateful aggregate)."""
    return labels.label_counts(posts.posts(pages))


def write_post_metrics(stream: DataFrame, path: str, checkpoint: str | None = None, trigger_once: bool = False) -> StreamingQuery:
    """Append post counters to Parquet; progress in ``checkpoint`` (default: under the shared folder)."""
    spark = stream.sparkSession
    if checkpoint is None:
        checkpoint = ensure_checkpoint_dir(spark).rstrip("/") + "/stream-post-metrics"
    w = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
