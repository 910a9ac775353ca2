"""Run registered queries against their SQL on one scale folder and report differences.

Usage: python -m checks.compare [scale folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

from checks.oracle import ORACLE
from checks.queries import QUERIES
from tidemark.session import local_session


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values as text, rows sorted: equal frames get equal text."""
    out = {}
    for c in sorted(frame.columns):
        s = frame[c]
        if pd.api.types.is_datetime64_any_dtype(s):
            s = s.astype("datetime64[us]")
        out[c] = [_text(v) for v in s]
    text = pd.DataFrame(out)
    return text.sort_values(list(text.columns), ignore_index=True)


def _text(v) -> str:
    if v is None or v is pd.NaT:
        return "NULL"
    if isinstance(v, float):
        return "NULL" if v != v else repr(float(v)) if v % 1 else repr(int(v))
    if pd.isna(v):
        return "NULL"
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return str(v)


def difference(spark, con, name: str, sf_dir: str) -> str:
    """Empty when query and SQL agree in columns, types, rows and values."""
    df = QUERIES[name](spark, sf_dir)
    got = df.toPandas()
    rel = con.sql(ORACLE[name])
    want = rel.df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(set(got.columns) ^ set(want.columns))}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}
    types = dict(zip(rel.columns, map(str, rel.types)))
    off = [(c, t, types[c]) for c, t in df.dtypes if kinds.get(t, t) != types[c]]
    a, b = canonical(got), canonical(want)
    if len(a) != len(b):
        return f"rows {len(a)} and {len(b)}, types {off}"
    if not a.equals(b):
        bad = [c for c in a.columns if not a[c].equals(b[c])]
        at = next(i for i in range(len(a)) if not a.loc[i].equals(b.loc[i]))
        return f"values in {bad}, types {off}\n  {a.loc[at].to_dict()}\n  {b.loc[at].to_dict()}"
    if off:
        return f"types {off}"
    return "" if len(a) else "no rows"


def main(args: list[str]) -> int:
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(QUERIES)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for name in names:
        began = time.time()
        try:
            if name in ORACLE:
                found = difference(spark, con, name, sf_dir)
            else:
                rows = QUERIES[name](spark, sf_dir).count()
                found = "" if rows else "no rows"
        except Exception as e:  # one broken query must not hide the others
            found = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += bool(found)
        kind = "sql" if name in ORACLE else "rows"
        print(f"{'FAIL' if found else 'ok  '} {kind:4} {time.time() - began:6.2f}s {name} {found}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
