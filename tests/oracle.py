"""Compare every registered query with its SQL on the same parquet tables.

Run as a script with a folder and optional query names, or use ``differences`` from a test.
"""

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder):
    link = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        link.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return link


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, link, sql):
    """None when result and SQL agree in columns and values, else a short account."""
    names, mine = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = link.execute(sql)
    other_names, other = _sorted_rows([d[0] for d in cursor.description], cursor.fetchall())
    if names != other_names:
        return f"columns {names} != {other_names}"
    if mine != other:
        only, missing = sorted(set(mine) - set(other))[:3], sorted(set(other) - set(mine))[:3]
        return f"{len(mine)} rows, SQL {len(other)}; only here {only}; only in SQL {missing}"
    return None


def main(folder, *wanted):
    from __spark_entry__ import oracle_sql, queries
    from permitry.session import local_session

    spark, link, sql = local_session(8, 8), connect(folder), oracle_sql()
    bad = 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            found = query(spark, folder)
            verdict = differences(found, link, sql[name]) if name in sql else f"no SQL, {len(found.collect())} rows"
        except Exception as error:  # noqa: BLE001
            verdict = f"{type(error).__name__}: {str(error)[:1500]}"
        failed = verdict is not None and not verdict.startswith("no SQL")
        bad += failed
        print(f"{'BAD' if failed else 'ok '} {name} {time.time() - began:.2f}s {verdict or ''}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(*sys.argv[1:])
