"""Run registered queries next to their SQL and compare the results.

Usage: python tests/compare.py [folder] [name or prefix ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DEFAULT_FOLDER = "/root/testdata/sf0.01"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, (int, float)):
        number = float(value)
        return "nan" if math.isnan(number) else number + 0.0
    return str(value)


def as_counter(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(row[i]) for i in order) for row in rows)


def families(kinds: list[str]) -> list[str]:
    """Type families both engines share; anything else is shown as it is."""
    names = {
        "int": ["tinyint", "smallint", "int", "integer", "bigint"],
        "float": ["double", "float"],
        "text": ["string", "varchar"],
        "bool": ["boolean"],
    }
    return [next((f for f, members in names.items() if k.lower() in members), k) for k in kinds]


def compare(spark, con, name: str, folder: str) -> tuple[bool, str]:
    from telemorph.queries import ORACLES, QUERIES

    df = QUERIES[name](spark, folder)
    got = as_counter(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return True, f"{sum(got.values())} rows, no SQL"
    cursor = con.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    want = as_counter(columns, cursor.fetchall())
    if sorted(columns) != sorted(df.columns):
        return False, f"columns differ: {sorted(df.columns)} vs {sorted(columns)}"
    ours = dict(zip(df.columns, families([f.dataType.simpleString() for f in df.schema])))
    theirs = dict(zip(columns, families([str(c[1]) for c in cursor.description])))
    if ours != theirs:
        return False, f"types differ: {sorted(set(ours.items()) ^ set(theirs.items()))}"
    if got != want:
        return False, f"rows {sum(got.values())} vs {sum(want.values())}; only ours {list((got - want))[:3]}; only SQL {list((want - got))[:3]}"
    return True, f"{sum(got.values())} rows"


def main() -> int:
    from telemorph.queries import QUERIES
    from telemorph.session import local_session

    args = sys.argv[1:]
    folder = args.pop(0) if args and os.path.isdir(args[0]) else DEFAULT_FOLDER
    names = [n for n in QUERIES if not args or any(n.startswith(a) for a in args)]
    spark, con = local_session("8"), connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            ok, note = compare(spark, con, name, folder)
        except Exception as error:  # noqa: BLE001
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not ok
        if not ok or "-q" not in os.environ.get("COMPARE", ""):
            print(f"{'ok ' if ok else 'BAD'} {name} {time.time() - start:.1f}s {note}", flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
