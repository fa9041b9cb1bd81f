"""Compare registered queries with their SQL twins: ``python tests/check_oracle.py [sf] [name ...]``."""

from __future__ import annotations

import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

_KINDS = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "date": "DATE",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else repr(round(value, 9) + 0.0)
    return value


def _rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([_cell(row[i]) for i in order] for row in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str, query, sql: str) -> str | None:
    """``None`` when equal, otherwise what differs."""
    frame = query(spark, sf_dir)
    got = _rows(frame.collect(), frame.columns)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    want = _rows(result.fetchall(), names)
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    for column, kind in frame.dtypes:
        if _KINDS.get(kind, kind) != kinds[column]:
            return f"type of {column}: {kind} != {kinds[column]}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"row {g} != {w}"
    return None


def main() -> int:
    from coffer.session import ledger_session

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = ledger_session(master="local[8]", cores=8)
    con = oracle_connection(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    failed = 0
    for name in names:
        start = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, sf_dir, name, queries[name], sqls[name])
                note = f"{queries[name](spark, sf_dir).count()} rows"
            else:
                problem, note = None, f"{queries[name](spark, sf_dir).count()} rows, no SQL twin"
        except Exception as error:  # report and go on with the next query
            problem, note = f"{type(error).__name__}: {str(error)[:1500]}", ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or note}", flush=True)
    print(f"{len(names) - failed} of {len(names)} ok")
    return failed


if __name__ == "__main__":
    sys.exit(main())
