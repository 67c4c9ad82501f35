"""Compare a Spark result with its SQL twin, row by row, whatever the order."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when equal, else what differs."""
    cursor = con.execute(sql)
    expected_names = [d[0] for d in cursor.description]
    expected_rows = cursor.fetchall()
    if sorted(expected_names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(expected_names)}"
    order = sorted(expected_names)
    ours = Counter(tuple(_plain(row[c]) for c in order) for row in df.collect())
    position = [expected_names.index(c) for c in order]
    theirs = Counter(tuple(_plain(row[i]) for i in position) for row in expected_rows)
    # bool and int compare equal in Python, so types are compared too.
    kinds = [{type(v) for row in side for v in (row[i],) if v is not None}
             for i in range(len(order)) for side in (ours, theirs)]
    for i, name in enumerate(order):
        if kinds[2 * i] != kinds[2 * i + 1]:
            return f"types of {name}: {kinds[2 * i]} instead of {kinds[2 * i + 1]}"
    if ours != theirs:
        extra, lacking = list((ours - theirs).items())[:2], list((theirs - ours).items())[:2]
        return (f"{sum(ours.values())} rows instead of {sum(theirs.values())}; {order}\n"
                f"  only ours: {extra}\n  only theirs: {lacking}")
    return ""


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from reviewlake.session import local_session

    sf_dir, wanted = argv[0], argv[1:]
    spark, con = local_session(8), connect(sf_dir)
    failed = 0
    oracles = oracle_sql()
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            found = differences(query(spark, sf_dir), con, oracles[name])
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(found)
        print(f"{name:28s} {time.time() - began:6.2f}s  {found or 'equal'}", flush=True)
    print(f"{failed} differ")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
