"""Run registered queries in Spark and DuckDB and compare rows: ``python -m postpulse.checks.compare DIR [NAME ...]``."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

import duckdb
import pandas as pd

from postpulse.checks.queries import ORACLES, QUERIES
from postpulse.session import build_session


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = []
    for row in frame.itertuples(index=False, name=None):
        rows.append(tuple(None if v is None or v is pd.NaT or v != v else str(v) for v in row))
    return sorted(rows, key=lambda r: tuple((v is None, v or "") for v in r))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def difference(spark, con, folder: str, name: str) -> str:
    """Empty when both engines agree."""
    ours = QUERIES[name](spark, folder).toPandas()
    if name not in ORACLES:
        return "" if len(ours) else "no rows"
    theirs = con.execute(ORACLES[name]).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} / {sorted(theirs.columns)}"
    kinds = {c: (ours[c].dtype, theirs[c].dtype) for c in ours.columns if ours[c].dtype != theirs[c].dtype}
    for c, (a, b) in kinds.items():
        if a.kind == "f" or b.kind == "f":
            ours[c], theirs[c] = ours[c].astype(float), theirs[c].astype(float)
    left, right = canonical(ours), canonical(theirs)
    if left != right:
        only = [r for r in left if r not in set(right)][:2], [r for r in right if r not in set(left)][:2]
        return f"rows {len(left)} / {len(right)}; only ours {str(only[0])[:600]}; only theirs {str(only[1])[:600]}"
    return f"(types {kinds})" if kinds else ""


def main(folder: str, *names: str) -> int:
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name in names or QUERIES:
        started = time.time()
        try:
            result = difference(spark, con, folder, name)
        except Exception as error:
            if names:
                traceback.print_exc()
            result = f"{type(error).__name__}: {str(error)[:500]}"
        bad += bool(result) and not result.startswith("(types")
        print(f"{time.time() - started:6.1f}s {name}: {result or 'ok'}", flush=True)
    print("differences:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
