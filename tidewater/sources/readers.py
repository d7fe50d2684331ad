"""Scans: nested JSON pages, flat tables by format, tolerant multi-format scans.

Readers take explicit schemas where the layout is known (no inference pass
over the data) and let Catalyst push filters and column pruning into the
scan.  File provenance comes from the ``_metadata.file_path`` column.
"""

from __future__ import annotations

import datetime as dt
from collections import Counter
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType

from ..schemas import page_schema, single_post_schema
from ..session import staged
from .arrow import FILE_COLUMN, merged_schema, register_arrow
from .arrow import FORMAT as ARROW_FORMAT


def read_pages(spark: SparkSession, path: str, schema: StructType | None = None, single: bool = False) -> DataFrame:
    """JSON-lines pages with a fixed schema (missing fields -> NULL, never inferred).

    ``single`` reads sample-stream lines whose ``data`` is one post.
    """
    if schema is None:
        schema = single_post_schema() if single else page_schema()
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def _struct(spark: SparkSession, schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | str | None = None,
    header: bool = True,
    sep: str = ",",
    with_file: bool = False,
) -> DataFrame:
    """Flat table by format: parquet, csv (plain or .gz), tsv, json, arrow.

    ``with_file`` adds ``source_file`` to Arrow tables, which have no file metadata.
    Without a schema an Arrow table has the columns of all its files.
    """
    fmt = fmt.lower()
    if fmt == "parquet":
        r = spark.read
        return (r.schema(schema) if schema else r).parquet(path)
    if fmt in ("csv", "tsv"):
        r = spark.read.option("header", header).option("sep", "\t" if fmt == "tsv" else sep)
        r = r.schema(schema) if schema else r.option("inferSchema", True)
        return r.csv(path)
    if fmt == "json":
        r = spark.read
        return (r.schema(schema) if schema else r).json(path)
    if fmt == "arrow":
        register_arrow(spark)
        schema = merged_schema(spark, path) if schema is None else schema
        fields = _struct(spark, schema).fields
        full = StructType([*fields, StructField(FILE_COLUMN, StringType())] if with_file else fields)
        return spark.read.format(ARROW_FORMAT).schema(full).option("with_file", str(with_file).lower()).load(path)
    raise ValueError(f"unknown format {fmt!r}")


def first_column(df: DataFrame) -> DataFrame:
    """Only the first column (an id list)."""
    return df.select(df.columns[0])


SUFFIX_FORMATS = (
    (".csv.gz", "csv"),
    (".csv", "csv"),
    (".arrow", "arrow"),
    (".parquet", "parquet"),
)


def format_of(path: str) -> str | None:
    for suffix, fmt in SUFFIX_FORMATS:
        if path.endswith(suffix):
            return fmt
    return None


#: A probe of a file reads at most this much of its text.
PROBE_BYTES = 1 << 16
PROBED = "path string, format string, size long, columns string, reason string"


def _why_not(path: str, fmt: str, whole: bool) -> tuple[int, str, str | None]:
    """(bytes, columns as JSON, None or why the file cannot be read), found in a task."""
    import gzip
    import json

    import pyarrow.parquet as pq
    from pyarrow import fs

    from .arrow import _open, _store

    store, inner = _store(path)
    info = store.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        return 0, "[]", "missing"
    if info.type == fs.FileType.Directory:  # Spark's readers take folders
        return 0, "[]", None
    if info.size == 0:
        return 0, "[]", "empty"
    if fmt == "parquet":
        with store.open_input_file(inner) as f:
            file = pq.ParquetFile(f)
            names = file.schema_arrow.names
            for i in range(file.metadata.num_row_groups):
                group = file.metadata.row_group(i)
                for j in range(group.num_columns):
                    column = group.column(j)
                    start = column.dictionary_page_offset or column.data_page_offset
                    if start + column.total_compressed_size > info.size:
                        raise ValueError("a column chunk lies outside the file")
                if whole:
                    file.read_row_group(i)
    elif fmt == "arrow":
        reader, random_access = _open(path)
        names = reader.schema.names
        batches = (reader.get_batch(i) for i in range(reader.num_record_batches)) if random_access else reader
        for batch in batches if whole else ():
            batch.validate()
    else:
        with store.open_input_stream(inner, compression=None) as raw:
            f = gzip.open(raw) if path.endswith(".gz") else raw
            head = f.read(PROBE_BYTES)
            # a piece may end within a character
            names = head.decode("utf-8", "strict" if len(head) < PROBE_BYTES else "ignore").split("\n")[0].rstrip("\r").split(",")
            while (whole or path.endswith(".gz")) and f.read(1 << 20):  # only reading on shows a cut gzip file
                pass
    return info.size, json.dumps(names), None


def probe(spark: SparkSession, paths: list[str] | DataFrame, whole: bool = False) -> DataFrame:
    """``path, format, size, columns, reason``: what tasks find when they open each file.

    ``reason`` is NULL if the file can be read.  A list or a table with a ``path`` column;
    one job, whatever the number of files.  Parquet and Arrow files are judged by their
    footers, gzip by unpacking them, plain CSV by its first block; ``whole`` reads
    everything.  Files of a store that only Spark opens count as readable.
    """
    if not isinstance(paths, DataFrame):
        paths = spark.createDataFrame([(p,) for p in paths], "path string")
    formats = SUFFIX_FORMATS

    def run(batches):
        import pandas as pd
        import pyarrow as pa

        for pdf in batches:
            rows = []
            for path in pdf["path"]:
                fmt = next((f for suffix, f in formats if path.endswith(suffix)), None)
                size, names, reason = 0, "[]", "unknown format"
                if fmt is not None:
                    try:
                        size, names, reason = _why_not(path, fmt, whole)
                    except pa.ArrowInvalid as e:
                        reason = None if "Unrecognized filesystem" in str(e) else str(e).split("\n")[0][:200]
                    except Exception as e:  # any reader's error is the reason that is reported
                        reason = f"{type(e).__name__}: {e}".split("\n")[0][:200]
                rows.append((path, fmt, size, names, reason))
            yield pd.DataFrame(rows, columns=["path", "format", "size", "columns", "reason"])

    tasks = 4 * spark.sparkContext.defaultParallelism
    return paths.select("path").repartition(tasks, "path").mapInPandas(run, PROBED)


def _scan_files(spark: SparkSession, fmt: str, files: list[str], schema: StructType | str | None) -> DataFrame:
    if fmt == "arrow":
        return read_table(spark, ",".join(files), "arrow", schema, with_file=True)
    r = spark.read.option("ignoreMissingFiles", "true").option("ignoreCorruptFiles", "true")
    if fmt == "csv":
        r = r.option("header", True)
        df = (r.schema(schema) if schema else r.option("inferSchema", True)).csv(files)
    else:
        df = (r.schema(schema) if schema else r.option("mergeSchema", "true")).parquet(*files)
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def scan_any(
    spark: SparkSession,
    paths: list[str] | DataFrame,
    schema: StructType | str | None = None,
    skipped: list[tuple[str, str]] | None = None,
    whole: bool = False,
) -> DataFrame | None:
    """Read files of mixed formats, chosen by suffix; missing, unreadable or empty files are left out.

    All files are probed by tasks in one job (``probe``, which also gives the skipped
    files as a table), then read grouped by format and, for CSV, by header, so that each file's
    columns are taken by name; the groups are unioned by name, with a
    ``source_file`` column.  A Parquet or CSV file that breaks further on gives the rows
    before the break; ``whole=True`` reads every file once before, and leaves such
    files out.  ``skipped`` receives ``(path, reason)`` of every file left out.
    Returns None when no file could be read.
    """
    found = staged(probe(spark, paths, whole), "probe")
    if skipped is not None:
        skipped += [(r["path"], r["reason"]) for r in found.where(F.col("reason").isNotNull()).collect()]
    layout = F.when(F.col("format") == "csv", F.col("columns")).otherwise(F.lit(""))
    groups = found.where(F.col("reason").isNull()).groupBy("format", layout.alias("layout"))
    frames = []
    for r in sorted(groups.agg(F.sort_array(F.collect_list("path")).alias("paths")).collect(), key=lambda r: (r["format"], r["layout"])):
        frames.append(_scan_files(spark, r["format"], r["paths"], schema))
    if not frames:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def scan_glob(spark: SparkSession, pattern: str, fmt: str = "parquet", schema: StructType | str | None = None) -> DataFrame:
    """Many files by glob pattern as one table, with ``source_file`` provenance."""
    df = read_table(spark, pattern, fmt, schema, with_file=True)
    if fmt == "arrow":
        return df
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def expand_paths(
    spark: SparkSession,
    tickers: DataFrame,
    start: str,
    end: str,
    template: str = "{base}/{ticker}/{date}-{ticker}-{kind}.{suffix}",
    base: str = "data/raw",
    kind: str = "trade",
    suffix: str = "parquet",
) -> DataFrame:
    """(ticker, date, path): one path per ticker and calendar day in [start, end].

    ``tickers`` is a DataFrame with a ``ticker`` column; days come from
    ``sequence`` + ``explode``, paths from ``format_string``.
    """
    fmt = template.replace("{base}", base).replace("{kind}", kind).replace("{suffix}", suffix)
    fmt = fmt.replace("%", "%%").replace("{ticker}", "%1$s").replace("{date}", "%2$s")
    days = F.explode(F.sequence(F.lit(dt.date.fromisoformat(start)), F.lit(dt.date.fromisoformat(end)), F.expr("interval 1 day")))
    return tickers.select("ticker").distinct().select("ticker", days.alias("date")).withColumn(
        "path", F.format_string(fmt, F.col("ticker"), F.date_format("date", "yyyy-MM-dd"))
    )


def paired_paths(
    spark: SparkSession,
    tickers: DataFrame,
    start: str,
    end: str,
    base: str = "data/raw",
    trade_kind: str = "trade",
    quote_kind: str = "bbo",
    suffix: str = "parquet",
) -> DataFrame:
    """(ticker, date, trade_path, quote_path): both tick files of a ticker-day.

    The quote path is its own template fill, not a text replacement in the
    trade path, so a ticker or base folder containing the word is left alone.
    """
    trade = expand_paths(spark, tickers, start, end, base=f"{base}/{trade_kind}", kind=trade_kind, suffix=suffix)
    lit = lambda v: v.replace("%", "%%")
    fmt = f"{lit(base)}/{lit(quote_kind)}/%1$s/%2$s-%1$s-{lit(quote_kind)}.{lit(suffix)}"
    return trade.select(
        "ticker", "date", F.col("path").alias("trade_path"),
        F.format_string(fmt, F.col("ticker"), F.date_format("date", "yyyy-MM-dd")).alias("quote_path"),
    )


def schema_leaves(schema: DataType, prefix: str = "") -> list[tuple[str, str]]:
    """(dotted leaf path, type name) of every leaf; array elements marked ``[]``."""
    if isinstance(schema, StructType):
        out: list[tuple[str, str]] = []
        for f in schema.fields:
            out.extend(schema_leaves(f.dataType, f"{prefix}.{f.name}" if prefix else f.name))
        return out
    if isinstance(schema, ArrayType):
        return schema_leaves(schema.elementType, prefix + "[]")
    if isinstance(schema, MapType):
        return schema_leaves(schema.valueType, prefix + "{}")
    return [(prefix, schema.simpleString())]


def schema_drift(spark: SparkSession, schemas: list[StructType]) -> DataFrame:
    """(leaf, type, n_runs): in how many of the given schemas each leaf occurs."""
    counts = Counter(leaf for s in schemas for leaf in set(schema_leaves(s)))
    rows = [(leaf, typ, n) for (leaf, typ), n in sorted(counts.items())]
    return spark.createDataFrame(rows, "leaf string, type string, n_runs long")


def variant_leaves(schema: str) -> list[tuple[str, str]]:
    """(dotted leaf path, type) of a schema as ``schema_of_variant`` prints it; elements marked ``[]``."""
    at, out = 0, []

    def value(prefix: str) -> None:
        nonlocal at
        if schema.startswith("OBJECT<>", at):
            at += len("OBJECT<>")
            out.append((prefix, "OBJECT"))
            return
        for word in ("OBJECT<", "ARRAY<"):
            if schema.startswith(word, at):
                at += len(word)
                if word == "ARRAY<":
                    value(prefix + "[]")
                else:
                    fields(prefix)
                at += 1  # the closing bracket
                return
        begin, depth = at, 0
        while at < len(schema) and (depth or schema[at] not in ",>"):
            depth += {"(": 1, ")": -1}.get(schema[at], 0)
            at += 1
        out.append((prefix, schema[begin:at]))

    def fields(prefix: str) -> None:
        nonlocal at
        while True:
            if schema[at] == "`":
                end = at + 1
                while schema[end] != "`" or schema[end + 1 : end + 2] == "`":
                    end += 2 if schema[end] == "`" else 1
                name, at = schema[at + 1 : end].replace("``", "`"), end + 1
            else:
                end = schema.index(":", at)
                name, at = schema[at:end], end
            at += 2  # ": "
            value(f"{prefix}.{name}" if prefix else name)
            if not schema.startswith(", ", at):
                return
            at += 2

    value("")
    return out


def captured_schema(lines: DataFrame, group: str = "source_file", value: str = "value") -> DataFrame:
    """``group, leaf, type`` of JSON lines: the merged schema of every group, found from the data.

    Each line is parsed to a VARIANT and the schemas of a group are merged by a partial
    aggregate, so a file with a third of all lines ships one schema per task.  Lines that
    are not JSON are left out; one schema a group is turned into leaves.
    """
    kind = lines.schema[group].dataType.simpleString()
    parsed = lines.select(F.col(group).alias("_group"), F.try_parse_json(value).alias("_json")).where(F.col("_json").isNotNull())
    merged = parsed.groupBy("_group").agg(F.schema_of_variant_agg("_json").alias("_schema"))

    def run(batches):
        import pandas as pd

        for pdf in batches:
            rows = [(g, leaf, kind) for g, schema in zip(pdf["_group"], pdf["_schema"], strict=True) for leaf, kind in variant_leaves(schema)]
            yield pd.DataFrame(rows, columns=["_group", "leaf", "type"])

    return merged.mapInPandas(run, f"_group {kind}, leaf string, type string").withColumnRenamed("_group", group)


def captured_drift(captured: DataFrame, group: str = "source_file") -> DataFrame:
    """``leaf, type, n_groups, everywhere``: in how many groups each leaf has each type."""
    n = captured.select(group).distinct().agg(F.count(F.lit(1)).alias("_n"))
    found = captured.groupBy("leaf", "type").agg(F.count_distinct(group).alias("n_groups"))
    return found.join(F.broadcast(n)).select("leaf", "type", "n_groups", (F.col("n_groups") == F.col("_n")).alias("everywhere"))
