"""Run registered queries on Spark and their SQL on DuckDB and compare all rows.

    python tests/check_oracle.py [folder] [name …]
"""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _kind(dtype) -> str:
    name = str(dtype)
    if name in ("object", "str", "string"):
        return "text"
    return "float64" if name == "Int64" else name  # whole numbers with nulls


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns), kind="stable", na_position="last").reset_index(drop=True)


def differences(got: pd.DataFrame, want: pd.DataFrame) -> list[str]:
    """Empty when both frames hold the same rows, columns and types."""
    if sorted(got.columns) != sorted(want.columns):
        return [f"columns {sorted(got.columns)} != {sorted(want.columns)}"]
    if len(got) != len(want):
        return [f"rows {len(got)} != {len(want)}"]
    got, want = canonical(got), canonical(want)
    found = []
    for c in got.columns:
        if _kind(got[c].dtype) != _kind(want[c].dtype):
            found.append(f"type of {c}: {got[c].dtype} != {want[c].dtype}")
        if got[c].dtype.kind == "f" or want[c].dtype.kind == "f":
            a, b = got[c].astype(float).to_numpy(), want[c].astype(float).to_numpy()
            same = (a == b) | (np.isnan(a) & np.isnan(b))
        else:
            a, b = got[c], want[c]
            same = ((a == b) | (a.isna() & b.isna())).to_numpy()
        if not same.all():
            i = int(np.argmin(same))
            found.append(f"{c}: {(~same).sum()} rows differ, first {got.iloc[i].to_dict()} != {want.iloc[i].to_dict()}")
    return found


def main() -> None:
    import __spark_entry__ as registered
    from shoal.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    QUERIES, ORACLES = registered.queries(), registered.oracle_sql()
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("check", "local[8]", 8, {"spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), []
    for name in names:
        start = time.time()
        try:
            got = QUERIES[name](spark, folder).toPandas()
            spent = time.time() - start
            if name in ORACLES:
                start = time.time()
                want = con.execute(ORACLES[name]).df()
                found = differences(got, want)
                note = f"duckdb {time.time() - start:.1f}s"
            else:
                found, note = [], "no SQL"
            if not len(got):
                found.append("no rows")
            print(f"{'ok  ' if not found else 'FAIL'} {name}: {len(got)} rows, spark {spent:.1f}s, {note}", flush=True)
            for line in found:
                print("     ", line[:600], flush=True)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            found = [str(error)]
            print(f"FAIL {name}: {type(error).__name__}: {str(error)[:900]}", flush=True)
            if "-v" in sys.argv:
                traceback.print_exc()
        if found:
            bad.append(name)
    print(f"{len(names) - len(bad)} of {len(names)} agree; failing: {' '.join(bad)}", flush=True)


if __name__ == "__main__":
    main()
