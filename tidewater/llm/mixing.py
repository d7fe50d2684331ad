"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

Every document of a source has the expected number of copies
``target / source_size``.  Documents are put in one order per source (by size,
so that large and small ones are taken evenly; then id), expected copies are
prefix-summed along it, one random offset per source is added, and a document
is emitted once per integer boundary that its interval crosses.

The order is a distributed sort.  A document's position is the position inside
its range partition plus the counts of that source in the partitions before
it, so a source with a third of all rows is spread over as many partitions as
its rows fill; only one count per (partition, source) is shuffled afterwards.

Defined results
  null text: size 0.  Null source: a source of its own, last in order.
  A source without words: target 0, no copies.  Empty table: no rows.
  Repeated rows: each is a document; their copies may be dealt either way, the
  rows that come out are the same.  Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import kept_lineage, n_words

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
SEED = "mix-1"
#: Rows of two numbers that may be broadcast: about 64 MB.
BROADCAST_ROWS = 1_000_000


def offset(source: Column, seed: str = SEED) -> Column:
    """The random offset of a source in [0, 1), a multiple of 2**-24 (reruns agree)."""
    name = F.concat(F.lit(seed), F.coalesce(F.concat(F.lit(":"), source), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, 6), 16, 10).cast("double") / F.lit(float(1 << 24))


def target_sizes(
    sizes: DataFrame, source: str, size: str, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_COPIES
) -> DataFrame:
    """One row per source: ``source, source_size, target``.

    Weights repeat along the sources in code-point order, null last.  Targets
    share the total in proportion to weight and stop at ``cap`` times the
    source's size, the excess being shared again: ``min(cap*size, level*weight)``
    with the level found from prefix sums over the sources by ``cap*size/weight``.
    The windows hold one row per source, not per document.
    """
    per = sizes.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    per = per.select("source", "source_size", rank.alias("rank"), weight.alias("weight"))
    limit = (F.col("source_size") * cap).cast("double")
    per = per.withColumn("limit", limit).withColumn("fill", F.col("limit") / F.col("weight"))
    before = Window.orderBy("fill", "rank").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    left = F.sum(F.col("source_size").cast("double")).over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    per = per.withColumn("step", left / open_weight)
    level = F.max("step").over(whole)
    share = level * F.col("weight")
    return per.select("source", "source_size", F.when(F.col("limit") <= share, F.col("limit")).otherwise(share).alias("target"))


def ranked(sizes: DataFrame, source: str, size: str, doc_id: str) -> DataFrame:
    """``sizes`` with ``position``: 1, 2, ... along each source by size, then id."""
    spark = sizes.sparkSession
    order = [F.col(source).asc_nulls_last(), F.col(size), F.col(doc_id).asc_nulls_last()]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = (
        sizes.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row"))
    )
    runs = kept_lineage(runs)
    counts = runs.groupBy("_part", F.col(source).alias("_of")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first")
    )
    earlier = Window.partitionBy("_of").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("_part").alias("_at"), "_of", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start")
    )
    return runs.join(starts, (F.col("_part") == F.col("_at")) & F.col(source).eqNullSafe(F.col("_of"))).select(
        *sizes.columns, (F.col("_start") + F.col("_row") - F.col("_first") + 1).alias("position")
    )


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    cap: int = MAX_COPIES,
    seed: str = SEED,
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken``."""
    sizes = kept_lineage(
        docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"))
    )
    targets = target_sizes(sizes, "source", "size", weights, cap).withColumnRenamed("source", "_source")
    placed = ranked(sizes, "source", "size", "doc_id").join(targets, F.col("source").eqNullSafe(F.col("_source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    u = offset(F.col("source"), seed)
    crossed = F.floor(F.col("position") * rate + u) - F.floor((F.col("position") - 1) * rate + u)
    copies = F.least(crossed, F.lit(cap)).cast("long")
    return placed.select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def emit(
    docs: DataFrame, mixed: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """The rows of ``docs`` as many times as ``mixed`` says, all columns kept.

    The mix (two numbers a row) is broadcast up to ``BROADCAST_ROWS`` rows, else
    joined by a shuffle.  Rows that share an id are matched to it one to one
    (by source and size).
    """
    columns = [F.col(c) for c in docs.columns]
    mixed = kept_lineage(mixed.select(F.col("doc_id").alias("_mix_id"), "source", "size", F.col("copies").alias("_mix_n")))
    again = kept_lineage(mixed.groupBy("_mix_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("_mix_id").alias("_again")))
    wanted = mixed.where("_mix_n > 0")
    same = F.col(doc_id).eqNullSafe(F.col("_mix_id"))

    def sized(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df

    def repeated(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_n").cast("int")))).select(*columns)

    if not again.limit(1).count():
        return repeated(docs.join(sized(wanted.select("_mix_id", "_mix_n")), same))
    is_again, mix_again = F.col(doc_id).eqNullSafe(F.col("_again")), F.col("_mix_id").eqNullSafe(F.col("_again"))
    once = docs.join(sized(again), is_again, "left_anti").join(sized(wanted.select("_mix_id", "_mix_n")), same)
    turn = Window.partitionBy(doc_id).orderBy(F.col(source).asc_nulls_last(), n_words(F.col(text)))
    nth = Window.partitionBy("_mix_id").orderBy(F.col("source").asc_nulls_last(), "size")
    rows = docs.join(sized(again), is_again, "left_semi").withColumn("_mix_turn", F.row_number().over(turn))
    numbered = mixed.join(sized(again), mix_again, "left_semi").withColumn("_mix_nth", F.row_number().over(nth))
    numbered = numbered.where("_mix_n > 0").select("_mix_id", "_mix_n", "_mix_nth")
    many = rows.join(numbered, same & (F.col("_mix_turn") == F.col("_mix_nth")))
    return repeated(once).unionByName(repeated(many))
