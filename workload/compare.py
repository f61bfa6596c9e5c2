"""Run registered queries next to their SQL on one data folder and compare all values."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from seismic_lake.session import local_session  # noqa: E402
from workload.oracles import ORACLES  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


KINDS = {"string": "varchar", "int": "integer"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def main(sf_dir: str, names: list[str]) -> int:
    spark, con = local_session(8), connect(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names or list(QUERIES):
        try:
            started = time.time()
            df = QUERIES[name](spark, sf_dir)
            got = rows_of(df.columns, [tuple(r) for r in df.collect()])
            took = time.time() - started
            if name not in ORACLES:
                print(f"ROWS  {name}: {len(got)} rows {took:.1f}s", flush=True)
                continue
            started = time.time()
            cur = con.execute(ORACLES[name])
            columns = [d[0] for d in cur.description]
            want = rows_of(columns, cur.fetchall())
            duck = time.time() - started
        except Exception as error:  # report and go on with the next query
            bad += 1
            print(f"ERROR {name}: {str(error)[:600]}", flush=True)
            continue
        types = {c: KINDS.get(t, t) for c, t in df.dtypes}
        other = {d[0]: str(d[1]).lower() for d in cur.description}
        if any(types[c] != other.get(c) for c in types):
            print("   types differ:", {c: (types[c], other.get(c)) for c in types if types[c] != other.get(c)})
        same = sorted(df.columns) == sorted(columns) and got == want
        bad += not same
        print(f"{'ok   ' if same else 'DIFF '} {name}: {len(got)} rows {took:.1f}s (sql {duck:.1f}s)", flush=True)
        if not same:
            print("   columns", sorted(df.columns), sorted(columns), len(got), len(want))
            a, b = set(got), set(want)
            print("   spark only", sorted(a - b)[:3], "\n   sql only  ", sorted(b - a)[:3], flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
