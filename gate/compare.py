"""Run queries and their SQL side by side and compare every value exactly.

    python -m gate.compare [scale folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from decimal import Decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return ("decimal", str(value.normalize()))
    if isinstance(value, float):
        return ("float", repr(value))
    return (type(value).__name__, str(value))


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(con, sql: str, df) -> str | None:
    """None if both sides hold the same columns and the same bag of rows, else a description."""
    result = con.execute(sql)
    want_columns = [c[0] for c in result.description]
    want = rows_of(want_columns, result.fetchall())
    got = rows_of(df.columns, df.collect())
    if sorted(want_columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(want_columns)}"
    if want == got:
        return None
    in_want, in_got = set(want), set(got)
    extra, missing = [r for r in got if r not in in_want], [r for r in want if r not in in_got]
    return f"{len(got)} rows against {len(want)}; {len(extra)} differ, e.g.\n  {extra[:2]}\n  {missing[:2]}"


def main(argv: list[str]) -> int:
    from gate.oracle import ORACLE
    from gate.queries import QUERIES
    from tripgrain.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            problem = difference(con, ORACLE[name], QUERIES[name](spark, sf_dir)) if name in ORACLE else "no SQL"
        except Exception as error:  # keep going: one report over all queries
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'DIFF'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
