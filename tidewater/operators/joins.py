"""Join helpers with an explicit size check before broadcasting.

A derived small side (a vocabulary, per-text scores, per-user values) has
no reliable size estimate at planning time.  ``sized_join`` writes it
once as Parquet into the shared folder, measures its rows and bytes (strings,
binaries and arrays by their real lengths) and broadcasts it only within the
limits; otherwise it falls back to a shuffle join, which works for any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import staged

BROADCAST_MAX_ROWS = 5_000_000
BROADCAST_MAX_BYTES = 256 * 1024 * 1024


def _bytes(c: Column, t: T.DataType) -> Column:
    """Bytes of a value; nested values by their own lengths (NULL counts like a number)."""
    if isinstance(t, (T.StringType, T.BinaryType)):
        size = F.octet_length(c).cast("long")
    elif isinstance(t, T.ArrayType):
        size = F.aggregate(c, F.lit(0).cast("long"), lambda n, x: n + _bytes(x, t.elementType))
    elif isinstance(t, T.MapType):
        pairs = T.ArrayType(T.StructType([T.StructField("key", t.keyType), T.StructField("value", t.valueType)]))
        size = _bytes(F.map_entries(c), pairs)
    elif isinstance(t, T.StructType):
        size = sum((_bytes(c.getField(f.name), f.dataType) for f in t.fields), F.lit(0).cast("long"))
    else:
        return F.lit(8).cast("long")
    return F.coalesce(size, F.lit(0).cast("long")) + 16


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a table."""
    width = sum((_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(0).cast("long"))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return row["n"], row["b"]


def fits(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether a table's measured size is within the limits of a broadcast."""
    rows, size = measured(small)
    return rows <= max_rows and size <= max_bytes


def sized_join(
    big: DataFrame,
    small: DataFrame,
    on,
    how: str = "inner",
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
    materialize: bool = True,
) -> DataFrame:
    """``big.join(small)``; ``small`` broadcast only if its measured size is within bounds."""
    if materialize:
        small = staged(small, "side")
    if fits(small, max_rows, max_bytes):
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)
