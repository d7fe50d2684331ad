"""Trade and quote tick cleaning and merging.

A tick table has a ``ticker`` column, spreadsheet serial-day times
(``xltime``) and the tick-file value columns.  All days and tickers are
processed by one job; grouping keys always include the ticker, so one hot
ticker is spread over many (ticker, timestamp) groups and the partial
aggregates combine map-side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import between_time, serial_to_ts, to_zone

TRADE_VALUES = ("trade-price", "trade-volume")
QUOTE_VALUES = ("bid-price", "bid-volume", "ask-price", "ask-volume")


def regular_trades(df: DataFrame, flag: str = "trade-stringflag", value: str = "uncategorized") -> DataFrame:
    """Keep trades whose category flag equals ``value``."""
    return df.filter(F.col(flag) == value)


def with_local_time(df: DataFrame, tz: str = "America/New_York", source: str = "xltime") -> DataFrame:
    """Replace serial days by ``utc`` (the instant) and ``ts`` (exchange wall-clock time)."""
    return df.withColumn("utc", serial_to_ts(F.col(source))).withColumn("ts", to_zone(F.col("utc"), tz)).drop(source)


def _per_instant(df: DataFrame, keys: tuple[str, ...], aggs: list[Column], instant: str) -> DataFrame:
    """Groups by key and instant: on the day clocks go back, an hour's wall-clock
    times come twice and stay two rows."""
    if instant not in df.columns:
        return df.groupBy(*keys).agg(*aggs)
    return df.groupBy(*keys, instant).agg(*aggs).drop(instant)


def merge_sub_trades(df: DataFrame, keys: tuple[str, ...] = ("ticker", "ts"), instant: str = "utc") -> DataFrame:
    """One row per instant: mean price, total volume."""
    aggs = [F.avg("trade-price").alias("trade_price"), F.sum("trade-volume").alias("trade_volume")]
    return _per_instant(df, keys, aggs, instant)


def merge_sub_quotes(df: DataFrame, seq: str = "seq", keys: tuple[str, ...] = ("ticker", "ts"), values: tuple[str, ...] = QUOTE_VALUES, instant: str = "utc") -> DataFrame:
    """One row per instant: per column, the last non-null value in ``seq`` order."""
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(seq))).alias(c) for c in values]
    return _per_instant(df, keys, aggs, instant)


def clean_trades(
    df: DataFrame,
    tz: str = "America/New_York",
    regular_only: bool = True,
    hours_only: bool = True,
    open_time: str = "09:30:00",
    close_time: str = "16:00:00",
    merge: bool = True,
) -> DataFrame:
    """Category filter -> drop flags -> serial days to exchange time -> trading hours -> merge sub-trades."""
    if regular_only:
        df = regular_trades(df)
    df = df.drop("trade-rawflag", "trade-stringflag")
    df = with_local_time(df, tz)
    if hours_only:
        df = df.filter(between_time(F.col("ts"), open_time, close_time))
    if merge:
        return merge_sub_trades(df)
    return df.select("ticker", "ts", F.col("trade-price").alias("trade_price"), F.col("trade-volume").alias("trade_volume"))


def clean_quotes(
    df: DataFrame,
    tz: str = "America/New_York",
    hours_only: bool = True,
    open_time: str = "09:30:00",
    close_time: str = "16:00:00",
    merge: bool = True,
    seq: str = "seq",
) -> DataFrame:
    """Serial days to exchange time -> trading hours -> last non-null value per timestamp."""
    df = with_local_time(df, tz)
    if hours_only:
        df = df.filter(between_time(F.col("ts"), open_time, close_time))
    if merge:
        return merge_sub_quotes(df, seq)
    return df.drop(seq, "utc")


def merge_events(trades: DataFrame, quotes: DataFrame, keys: tuple[str, ...] = ("ticker", "ts")) -> DataFrame:
    """Full outer join of trades and quotes on (ticker, ts)."""
    return trades.join(quotes, list(keys), "full_outer")


def build_events(trades: DataFrame, quotes: DataFrame, **clean_kwargs) -> DataFrame:
    """Cleaned trades + quotes merged per ticker and day; days lacking either side are skipped.

    A side is there if its table has any row of the ticker and day, whatever
    cleaning leaves of it: a day whose trades are all special keeps its quotes.
    Day presence is a pair of semi joins on (ticker, date), so no per-day
    driver loop is needed.
    """
    t_options, q_options = clean_kwargs.get("trades", {}), clean_kwargs.get("quotes", {})
    t = clean_trades(trades, **t_options).withColumn("date", F.to_date("ts"))
    q = clean_quotes(quotes, **q_options).withColumn("date", F.to_date("ts"))

    def days(raw: DataFrame, options: dict) -> DataFrame:
        zone = {"tz": options["tz"]} if "tz" in options else {}
        return with_local_time(raw, **zone).select("ticker", F.to_date("ts").alias("date")).distinct()

    t_days, q_days = days(trades, t_options), days(quotes, q_options)
    t = t.join(q_days, ["ticker", "date"], "left_semi").drop("date")
    q = q.join(t_days, ["ticker", "date"], "left_semi").drop("date")
    return merge_events(t, q, ("ticker", "ts")).withColumn("date", F.to_date("ts"))


def concat_tables(dfs: list[DataFrame]) -> DataFrame:
    """Union by column name; columns missing on one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
