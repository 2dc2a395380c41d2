"""Run registered queries beside their SQL and compare row by row.

usage: python tests/sql_check.py [folder] [name ...]
"""

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def cell(value):
    """One printable form per value; numbers to 12 significant digits, type kept apart."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, (bool, int)):
        return f"int:{int(value)}"
    if isinstance(value, (float, decimal.Decimal)):
        kind = "float" if isinstance(value, float) else "decimal"
        return f"{kind}:{float(value) + 0.0:.12g}"
    if isinstance(value, (datetime.date, datetime.datetime)):
        return f"{type(value).__name__}:{value}"
    return f"str:{value}"


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def compare(frame, connection, sql):
    """None when equal, else what differs."""
    mine = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    different = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if different:
        return f"{len(different)} of {len(mine)} rows differ, first {different[0]}"
    return None


def main():
    from shoplens.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as entry

    spark = local_session(8)
    connection = connect(folder)
    queries, sql = entry.queries(), entry.oracle_sql()
    wanted = sys.argv[2:] or list(queries)
    unknown = set(sql) - set(queries)
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            frame = queries[name](spark, folder)
            if name in sql:
                verdict = compare(frame, connection, sql[name])
            else:
                verdict = f"(no SQL) {len(frame.collect())} rows"
        except Exception as error:  # report and go on with the next query
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        ok = verdict is None or verdict.startswith("(no SQL)")
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name} {time.time() - start:.1f}s {verdict or ''}", flush=True)
    print(f"{len(wanted)} queries, {bad} bad, {len(queries) - len(sql)} without SQL, unknown {unknown}")


if __name__ == "__main__":
    main()
