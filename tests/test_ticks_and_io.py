"""Tick cleaning/merging and the readers/writers."""

import datetime as dt
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewater.functions.time import between_time, serial_to_ts, ts_to_serial
from tidewater.operators import ticks
from tidewater.sources.readers import probe, expand_paths, paired_paths, read_table, scan_any, schema_drift, schema_leaves
from tidewater.sources.sinks import write_events, write_table


def test_serial_days(spark):
    df = spark.createDataFrame([(40179.5,), (25569.0,)], "x double")
    got = [r.t for r in df.select(F.unix_micros(serial_to_ts("x")).alias("t")).collect()]
    assert got[0] == int(dt.datetime(2010, 1, 1, 12, tzinfo=dt.timezone.utc).timestamp() * 1e6)
    assert got[1] == 0
    back = df.select(ts_to_serial(serial_to_ts("x")).alias("y")).collect()
    assert [r.y for r in back] == [40179.5, 25569.0]


def test_trading_hours_inclusive(spark):
    rows = [("2024-03-01 09:30:00",), ("2024-03-01 16:00:00",), ("2024-03-01 16:00:00.000001",), ("2024-03-01 09:29:59.999999",)]
    df = spark.createDataFrame(rows, "s string").select(F.to_timestamp("s").alias("ts"))
    kept = df.filter(between_time("ts")).count()
    assert kept == 2


def _trades(spark):
    # 2010-03-15 is after the US DST switch: 14:00 UTC = 10:00 New York
    base = (dt.datetime(2010, 3, 15, 14, 0) - dt.datetime(1899, 12, 30)).total_seconds() / 86400
    pdf = pd.DataFrame({
        "ticker": ["A", "A", "A", "A"],
        "xltime": [base, base, base + 1 / 86400, base + 0.5],
        "trade-price": [10.0, 12.0, 11.0, 9.0],
        "trade-volume": [1.0, 3.0, 2.0, 5.0],
        "trade-rawflag": ["", "", "", ""],
        "trade-stringflag": ["uncategorized", "uncategorized", "special", "uncategorized"],
    })
    return spark.createDataFrame(pdf)


def test_clean_trades_merges_sub_trades(spark):
    out = ticks.clean_trades(_trades(spark)).orderBy("ts").collect()
    # 14:00 UTC two sub-trades merged; special trade dropped; +12h is 22:00 NY local -> outside hours
    assert len(out) == 1
    assert out[0].trade_price == 11.0 and out[0].trade_volume == 4.0
    assert out[0].ts.hour == 10


def test_clean_quotes_last_non_null(spark):
    base = (dt.datetime(2010, 3, 15, 14, 0) - dt.datetime(1899, 12, 30)).total_seconds() / 86400
    pdf = pd.DataFrame({
        "ticker": ["A", "A", "A"], "seq": [1, 2, 3], "xltime": [base] * 3,
        "bid-price": [1.0, None, 3.0], "bid-volume": [5.0, 6.0, None],
        "ask-price": [None, 2.0, None], "ask-volume": [None, None, None],
    })
    out = ticks.clean_quotes(spark.createDataFrame(pdf, "ticker string, seq long, xltime double, `bid-price` double, `bid-volume` double, `ask-price` double, `ask-volume` double")).collect()
    assert len(out) == 1
    r = out[0].asDict()
    assert (r["bid-price"], r["bid-volume"], r["ask-price"], r["ask-volume"]) == (3.0, 6.0, 2.0, None)


def test_build_events_skips_days_missing_a_side(spark):
    t = _trades(spark)
    base = (dt.datetime(2010, 3, 16, 15, 0) - dt.datetime(1899, 12, 30)).total_seconds() / 86400
    q = spark.createDataFrame(pd.DataFrame({
        "ticker": ["A"], "seq": [1], "xltime": [base], "bid-price": [1.0], "bid-volume": [1.0],
        "ask-price": [2.0], "ask-volume": [1.0]}))
    assert ticks.build_events(t, q).count() == 0  # trades on the 15th, quotes on the 16th
    assert ticks.merge_events(ticks.clean_trades(t), ticks.clean_quotes(q)).count() == 2


def test_roundtrips(spark, tmp_path):
    df = spark.range(0, 50).select(F.col("id"), (F.col("id") * 1.5).alias("x"), F.col("id").cast("string").alias("s"))
    for fmt, comp in (("parquet", "zstd"), ("csv", "gzip"), ("json", None), ("arrow", "zstd")):
        path = str(tmp_path / fmt)
        write_table(df, path, fmt, compression=comp)
        back = read_table(spark, path, fmt, schema=df.schema if fmt in ("csv", "json") else None)
        assert sorted(map(tuple, back.select("id", "x", "s").collect())) == sorted(map(tuple, df.collect()))


def test_scan_any_tolerates_missing_and_unknown(spark, tmp_path):
    df = spark.range(0, 10)
    write_table(df, str(tmp_path / "p"), "parquet")
    files = [str(tmp_path / "p" / f) for f in os.listdir(tmp_path / "p")] + [str(tmp_path / "nope.parquet"), str(tmp_path / "x.txt")]
    got = scan_any(spark, files)
    assert got.count() == 10 and "source_file" in got.columns
    assert scan_any(spark, [str(tmp_path / "nope.csv")]) is None


def test_partitioned_events_prune(spark, tmp_path):
    df = spark.createDataFrame([("A", dt.date(2010, 1, 4), 1.0), ("B", dt.date(2010, 1, 5), 2.0)], "ticker string, date date, v double")
    write_events(df, str(tmp_path / "ev"))
    back = spark.read.parquet(str(tmp_path / "ev")).filter((F.col("ticker") == "A"))
    assert back.count() == 1
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_expand_paths(spark):
    tickers = spark.createDataFrame([("SPY",), ("SPY",), ("QQQ",)], "ticker string")
    out = expand_paths(spark, tickers, "2010-01-01", "2010-01-03", base="raw").collect()
    assert len(out) == 6
    assert "raw/SPY/2010-01-02-SPY-trade.parquet" in {r.path for r in out}


def test_paired_paths_keep_words_in_names(spark):
    # A ticker or base folder containing "trade" must not be rewritten in the quote path.
    tickers = spark.createDataFrame([("TRADE",), ("trades",)], "ticker string")
    out = {r.ticker: r for r in paired_paths(spark, tickers, "2010-01-01", "2010-01-01", base="trade-data").collect()}
    assert out["trades"].trade_path == "trade-data/trade/trades/2010-01-01-trades-trade.parquet"
    assert out["trades"].quote_path == "trade-data/bbo/trades/2010-01-01-trades-bbo.parquet"
    assert out["TRADE"].quote_path == "trade-data/bbo/TRADE/2010-01-01-TRADE-bbo.parquet"


def test_schema_drift(spark):
    a = spark.range(1).select(F.struct(F.lit(1).alias("x"), F.lit("s").alias("y")).alias("s")).schema
    b = spark.range(1).select(F.struct(F.lit(1).alias("x")).alias("s")).schema
    assert schema_leaves(a) == [("s.x", "int"), ("s.y", "string")]
    got = {(r.leaf, r.n_runs) for r in schema_drift(spark, [a, b]).collect()}
    assert got == {("s.x", 2), ("s.y", 1)}


def test_build_events_keeps_days_whose_trades_are_all_special(spark):
    t = _trades(spark).withColumn("trade-stringflag", F.lit("special"))
    base = (dt.datetime(2010, 3, 15, 15, 0) - dt.datetime(1899, 12, 30)).total_seconds() / 86400
    q = spark.createDataFrame(pd.DataFrame({
        "ticker": ["A"], "seq": [1], "xltime": [base], "bid-price": [1.0], "bid-volume": [1.0],
        "ask-price": [2.0], "ask-volume": [1.0]}))
    assert ticks.build_events(t, q).count() == 1


def test_the_hour_that_comes_twice_stays_two_instants(spark):
    """2010-11-07 in New York: 05:30 and 06:30 UTC are both 01:30."""
    days = [(dt.datetime(2010, 11, 7, h, 30) - dt.datetime(1899, 12, 30)).total_seconds() / 86400 for h in (5, 6)]
    pdf = pd.DataFrame({"ticker": ["A", "A"], "xltime": days, "trade-price": [10.0, 20.0], "trade-volume": [1.0, 3.0],
                        "trade-rawflag": ["", ""], "trade-stringflag": ["uncategorized"] * 2})
    out = ticks.clean_trades(spark.createDataFrame(pdf), hours_only=False).collect()
    assert sorted(r.trade_price for r in out) == [10.0, 20.0]


def test_hours_do_not_depend_on_the_session_zone(spark):
    from tidewater.functions.time import local_hour

    found = []
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            at = spark.range(1).select(F.timestamp_seconds(F.lit(1_700_000_000)).alias("t"))
            found.append(tuple(at.select(local_hour("t", 0).alias("h"), between_time("t", "22:00", "23:00").alias("b")).first()))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == [(22, True), (22, True)]


def test_scan_any_reads_every_format_and_reports_what_it_skips(spark, tmp_path):
    df = spark.range(10).select("id", F.col("id").cast("string").alias("s")).coalesce(1)
    files = []
    for fmt in ("arrow", "parquet", "csv"):
        write_table(df, str(tmp_path / fmt), fmt)
        files += [str(p) for p in (tmp_path / fmt).iterdir() if p.suffix == f".{fmt}"]
    assert scan_any(spark, files[:2]).count() == 20
    assert scan_any(spark, files[:1]).select("source_file").distinct().count() == 1
    uris = ["file://" + f for f in files]
    (tmp_path / "bad.parquet").write_bytes(b"not parquet")
    (tmp_path / "empty.csv").write_bytes(b"")
    skipped = []
    more = [str(tmp_path / "bad.parquet"), str(tmp_path / "empty.csv"), str(tmp_path / "none.csv"), "x.txt"]
    out = scan_any(spark, uris + more, "id long, s string", skipped)
    assert out.count() == 30 and {p for p, _ in skipped} == set(more)
    assert scan_any(spark, more) is None


def ids(spark, path, **options):
    return sorted(r.id for r in read_table(spark, str(path), "arrow", **options).collect())


def test_arrow_manifest_names_the_table(spark, tmp_path):
    path = tmp_path / "a"
    write_table(spark.range(10).coalesce(1), str(path), "arrow")
    before = read_table(spark, str(path), "arrow")
    (path / "part-00000-other-job.arrow").write_bytes(b"a writer that has not committed")
    write_table(spark.range(10, 30).repartition(3), str(path), "arrow")
    assert ids(spark, path) == list(range(10, 30))
    assert sorted(r.id for r in before.collect()) in (list(range(10)), list(range(10, 30)))
    assert (path / "part-00000-other-job.arrow").exists()
    write_table(spark.range(30, 33), str(path), "arrow", mode="append")
    assert ids(spark, path) == list(range(10, 33))
    for i in range(3):  # only what the last manifests name is kept
        write_table(spark.range(i, i + 1).coalesce(1), str(path), "arrow")
    assert ids(spark, path) == [2] and len(list(path.glob("part-*"))) <= 4


def test_arrow_failed_write_changes_nothing(spark, tmp_path):
    path = tmp_path / "a"
    write_table(spark.range(5), str(path), "arrow")
    names = sorted(p.name for p in path.iterdir())
    broken = spark.range(100).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("late"))).cast("long").alias("id"))
    with pytest.raises(Exception, match="late"):
        write_table(broken.repartition(4), str(path), "arrow")
    assert ids(spark, path) == list(range(5)) and sorted(p.name for p in path.iterdir()) == names


def test_arrow_empty_table_and_folder_without_files(spark, tmp_path):
    write_table(spark.range(0), str(tmp_path / "e"), "arrow")
    empty = read_table(spark, str(tmp_path / "e"), "arrow")
    assert empty.count() == 0 and empty.dtypes == [("id", "bigint")]
    (tmp_path / "none").mkdir()
    with pytest.raises(Exception, match="no Arrow files"):
        read_table(spark, str(tmp_path / "none"), "arrow").count()
    import pyarrow as pa

    with pa.ipc.new_file(str(tmp_path / "none" / "zero.arrow"), pa.schema([("id", pa.int64())])):
        pass
    assert ids(spark, tmp_path / "none") == []


def test_arrow_files_of_different_columns_and_shares_of_one_file(spark, tmp_path, monkeypatch):
    write_table(spark.range(3).coalesce(1), str(tmp_path / "a"), "arrow")
    write_table(spark.range(3, 5).select("id", F.lit("x").alias("s")).coalesce(1), str(tmp_path / "b"), "arrow")
    both = read_table(spark, f"{tmp_path / 'a'},{tmp_path / 'b'}", "arrow", with_file=True)
    assert sorted((r.id, r.s) for r in both.collect()) == [(0, None), (1, None), (2, None), (3, "x"), (4, "x")]
    assert both.select("source_file").distinct().count() == 2
    write_table(spark.range(3).select(F.col("id").cast("string")).coalesce(1), str(tmp_path / "c"), "arrow")
    with pytest.raises(Exception, match="another schema"):
        read_table(spark, f"{tmp_path / 'a'},{tmp_path / 'c'}", "arrow").count()
    import pyarrow as pa

    from tidewater.sources.arrow import ArrowReader, _Share
    from pyspark.sql.types import LongType, StructField, StructType

    with pa.ipc.new_file(str(tmp_path / "big.arrow"), pa.schema([("id", pa.int64())])) as f:
        for i in range(7):
            f.write_batch(pa.record_batch([pa.array([i])], names=["id"]))
    reader = ArrowReader([], StructType([StructField("id", LongType())]), False)
    shares = [[b.column(0)[0].as_py() for b in reader.read(_Share(str(tmp_path / "big.arrow"), i, 3))] for i in range(3)]
    assert sum(shares, []) == list(range(7)) and all(shares)


def test_probe_finds_broken_files_in_one_job(spark, tmp_path):
    import gzip

    good = spark.range(2000).select("id", F.col("id").cast("string").alias("s")).coalesce(1)
    for fmt in ("parquet", "csv", "arrow"):
        write_table(good, str(tmp_path / fmt), fmt)
    write_table(good, str(tmp_path / "gz"), "csv", compression="gzip")
    files = [next((tmp_path / d).glob(f"part-*.{suffix}")) for d, suffix in (("parquet", "parquet"), ("csv", "csv"), ("arrow", "arrow"), ("gz", "csv.gz"))]
    cut = tmp_path / "cut.csv.gz"
    cut.write_bytes(files[3].read_bytes()[:-200])
    half = tmp_path / "half.parquet"
    half.write_bytes(files[0].read_bytes()[:300])
    odd = tmp_path / "odd.arrow"
    odd.write_bytes(b"ARROW1 but no footer")
    (tmp_path / "empty.csv").write_bytes(b"")
    bad = [cut, half, odd, tmp_path / "empty.csv", tmp_path / "none.arrow", tmp_path / "x.txt"]
    table = {r.path: r for r in probe(spark, [str(p) for p in [*files, *bad]]).collect()}
    assert all(table[str(p)].reason is None and table[str(p)].size > 0 for p in files)
    assert all(table[str(p)].reason for p in bad)
    assert gzip.decompress(files[3].read_bytes()).startswith(b"id,s")
    skipped = []
    out = scan_any(spark, [str(p) for p in [*files, *bad]], "id long, s string", skipped)
    assert out.count() == 8000 and {p for p, _ in skipped} == {str(p) for p in bad}
    assert out.groupBy("source_file").count().count() == 4


def test_scan_any_takes_columns_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,s\n1,x\n")
    (tmp_path / "b.csv").write_text("s,id,t\ny,2,7\n")
    out = scan_any(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert sorted((str(r.id), r.s, r.t and str(r.t)) for r in out.collect()) == [("1", "x", None), ("2", "y", "7")]


def test_sized_join_measures_long_strings(spark):
    from tidewater.operators.joins import measured, sized_join

    small = spark.range(50).select("id", F.repeat(F.lit("x"), 10_000).alias("text"), F.array(F.lit("y" * 500)).alias("a"))
    rows, size = measured(small)
    assert rows == 50 and size > 50 * 10_500
    plan = sized_join(spark.range(100), small, "id", max_bytes=100_000)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan
