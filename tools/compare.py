"""Run registered queries and their SQL twins side by side and report differences.

    python tools/compare.py [--sf 0.01] [name ...]      names may end in *
"""

from __future__ import annotations

import argparse
import fnmatch
import os
import sys
import time
import traceback

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import duckdb  # noqa: E402

from millrace import tables  # noqa: E402
from millrace.plans import registry  # noqa: E402
from millrace.session import session  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in tables.NAMES:
        con.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tables.path_of(sf_dir, name)}')"
        )
    return con


def _cell(value):
    if value is None:
        return "\0"
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(_cell(v) for v in value) + "]"
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir: str, name: str):
    """None when both sides agree, else a text that says how they differ."""
    df = registry.QUERIES[name](spark, sf_dir)
    got_cols = df.columns
    got = [tuple(r) for r in df.collect()]
    if name not in registry.SQL:
        return None, len(got)
    cur = con.execute(registry.SQL[name])
    want_cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(got_cols) != sorted(want_cols):
        return f"columns {sorted(got_cols)} against {sorted(want_cols)}", len(got)
    if len(got) != len(want):
        return f"rows {len(got)} against {len(want)}", len(got)
    a, b = canonical(got_cols, got), canonical(want_cols, want)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(diff)} rows differ, first {diff[0]} (columns {sorted(got_cols)})", len(got)
    return None, len(got)


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("--parts", default="8")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    registry.load_all()
    names = [
        n for n in registry.QUERIES
        if not args.names or any(fnmatch.fnmatch(n, p) for p in args.names)
    ]
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark = session("compare", "local[8]", spark__sql__shuffle__partitions=args.parts,
                    spark__ui__enabled="false",
                    spark__ui__showConsoleProgress="false", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem, rows = compare(spark, con, sf_dir, name)
        except Exception as exc:  # report and go on with the next query
            problem, rows = f"{type(exc).__name__}: {str(exc)[:900]}", 0
            if os.environ.get("TRACE"):
                traceback.print_exc()
        kind = "sql " if name in registry.SQL else "rows"
        state = "ok  " if problem is None else "FAIL"
        bad += problem is not None
        print(f"{state} {kind} {name:32s} {rows:8d} rows {time.time() - start:6.2f}s {problem or ''}",
              flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
