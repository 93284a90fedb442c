"""Run catalogue queries next to their SQL on one scale folder.

    python tests/side_by_side.py [--dir DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from strataloom.plans import catalogue  # noqa: E402, F401
from strataloom.plans.registry import CATALOGUE  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value) -> str:
    if isinstance(value, decimal.Decimal):
        return f"decimal {value.normalize()}"
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    return repr(value)


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str) -> str:
    """``ok (n rows)`` or a description of the first difference."""
    query = CATALOGUE[name]
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    if query.sql is None:
        return f"ok ({len(got)} rows, no SQL)"
    cursor = con.execute(query.sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    expected = rows_of(names, cursor.fetchall())
    if got == expected:
        return f"ok ({len(got)} rows)"
    only_got = sorted(set(got) - set(expected))[:3]
    only_expected = sorted(set(expected) - set(got))[:3]
    return (
        f"differs: {len(got)} against {len(expected)} rows, columns {sorted(names)}\n"
        f"      spark {only_got}\n      sql   {only_expected}"
    )


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--dir", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    from strataloom.session import local_session

    spark, con, bad = local_session(8), duck(args.dir), 0
    for name in args.names or CATALOGUE:
        start = time.time()
        try:
            outcome = compare(spark, con, name, args.dir)
        except Exception as error:  # noqa: BLE001
            outcome = f"failed: {type(error).__name__}: {str(error)[:1500]}"
        bad += not outcome.startswith("ok")
        print(f"{name:34s} {time.time() - start:6.2f}s  {outcome}", flush=True)
    print(f"{bad} of {len(args.names or CATALOGUE)} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
