"""Runs registered queries next to their SQL and compares the rows as multisets, columns sorted by name.

As a script:  python tests/compare.py [--hot] [sf_dir] [name ...]
``--hot`` lowers the limits for hot keys so far that every operator takes its skew-proof form.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _multiset(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(repr(row[i]) for i in order) for row in rows)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when both sides agree, else what differs."""
    rows = spark_df.collect()
    cursor = con.execute(sql)
    names, want = _multiset([d[0] for d in cursor.description], cursor.fetchall())
    have_names, have = _multiset(spark_df.columns, rows)
    if have_names != names:
        return f"columns {have_names} != {names}"
    if have == want:
        return ""
    extra, missing = have - want, want - have
    return (
        f"rows {sum(have.values())} vs {sum(want.values())}; "
        f"only here {sum(extra.values())}: {list(extra)[:3]}; only in SQL {sum(missing.values())}: {list(missing)[:3]}"
    )


def force_hot_keys() -> None:
    from sessionflow.operators.skew import SkewPolicy
    from sessionflow.sources import bindings

    bindings.QUERY_SKEW = SkewPolicy(share=64, min_rows=1)


def main() -> int:
    import __spark_entry__ as entry
    from sessionflow.session import build_session

    arguments = [a for a in sys.argv[1:] if a != "--hot"]
    if len(arguments) < len(sys.argv) - 1:
        force_hot_keys()
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    wanted = arguments[1:]
    spark = build_session("local[8]", shuffle_partitions=8, app_name="compare", spark__driver__memory="12g")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            found = differences(query(spark, sf_dir), con, oracles[name]) if name in oracles else "no SQL"
        except Exception as error:  # report every query, not only the first failure
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(found)
        print(f"{'ok  ' if not found else 'DIFF'} {name:34s} {time.time() - started:6.2f}s {found}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
