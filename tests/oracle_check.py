"""Run every registered query next to its DuckDB oracle (like the driver's check).

usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from tidewater.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def pandas_rows(df) -> pd.DataFrame:
    """The rows in pandas, whole numbers with nulls kept whole (as DuckDB gives them)."""
    pdf = df.toPandas()
    return pdf.astype({c: "Int64" for c, kind in df.dtypes if kind == "bigint" and pdf[c].hasnans})


def norm(v):
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 9))
    if hasattr(v, "item"):
        return norm(v.item())
    return str(v)


def digest(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    rows = sorted("|".join(norm(r[c]) for c in cols) for r in pdf.to_dict("records"))
    return cols, len(rows), hashlib.md5("\n".join(rows).encode()).hexdigest(), rows


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            sdf = pandas_rows(fn(spark, sf))
        except Exception as e:  # noqa: BLE001
            print(f"FAIL-SPARK {name}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"rows-only {name}: {len(sdf)} rows {ts:.1f}s")
            continue
        try:
            odf = con.execute(sqls[name]).fetchdf()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL-SQL {name}: {str(e)[:400]}")
            bad += 1
            continue
        a, b = digest(sdf), digest(odf)
        if a[:3] == b[:3]:
            print(f"ok {name}: {a[1]} rows {ts:.1f}s")
        else:
            bad += 1
            print(f"MISMATCH {name}: spark cols={a[0]} n={a[1]} | sql cols={b[0]} n={b[1]}")
            sa, sb = set(a[3]), set(b[3])
            print("   spark-only:", list(sa - sb)[:3])
            print("   sql-only:  ", list(sb - sa)[:3])
    print("bad:", bad)


if __name__ == "__main__":
    main()
