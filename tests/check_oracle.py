"""Compare registered queries with their SQL: python tests/check_oracle.py SF_DIR [name …]"""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if hasattr(value, "as_tuple"):  # Decimal
        value = float(value)
    if isinstance(value, (bool, int, float)):
        return (1, repr(float(value)))
    return (2, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, sf_dir):
    """None when equal, else a description of the difference."""
    df = contract.queries()[name](spark, sf_dir)
    got_cols, got = rows_of(df.columns, df.collect())
    cur = con.execute(contract.oracle_sql()[name])
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    differing = [(g, w) for g, w in zip(got, want) if g != w]
    if differing:
        g, w = differing[0]
        cells = [(c, a[1], b[1]) for c, a, b in zip(got_cols, g, w) if a != b]
        return f"{len(differing)} of {len(got)} rows differ, e.g. {cells}"
    return None


if __name__ == "__main__":
    from conftest import new_session

    spark = new_session()
    sf_dir = sys.argv[1]
    con = connect(sf_dir)
    bad = 0
    for name in sys.argv[2:] or contract.queries():
        start = time.time()
        if name not in contract.oracle_sql():
            print(f"rows {name}: {contract.queries()[name](spark, sf_dir).count()} ({time.time() - start:.1f}s)")
            continue
        found = compare(spark, con, name, sf_dir)
        bad += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} ({time.time() - start:.1f}s) {found or ''}", flush=True)
    sys.exit(bad)
