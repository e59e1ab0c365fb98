"""Compare registered queries with their SQL on one scale factor.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from odotrack.session import get_spark  # noqa: E402


def normal(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, pd.Timestamp) or hasattr(value, "isoformat"):
        return pd.Timestamp(value).tz_localize(None).isoformat()
    return value.item() if hasattr(value, "item") else value


def rows_of(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(row[i]) for i in order) for row in records), key=repr)


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def compare(spark, con, name, sf_dir):
    """(Spark rows, SQL rows, differing rows, seconds in Spark, seconds in SQL)."""
    started = time.time()
    df = queries()[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    spark_seconds = time.time() - started
    started = time.time()
    result = con.execute(oracle_sql()[name])
    names = [column[0] for column in result.description]
    wanted = rows_of(names, result.fetchall())
    assert sorted(names) == sorted(df.columns), (sorted(names), sorted(df.columns))
    different = [pair for pair in zip(got, wanted) if pair[0] != pair[1]]
    return got, wanted, different, spark_seconds, time.time() - started


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = get_spark(
        "oracle-check", **{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    database, bad = connect(folder), []
    for query in sys.argv[2:] or list(queries()):
        if query not in oracle_sql():
            print(f"{query:32} no SQL, {queries()[query](session, folder).count()} rows", flush=True)
            continue
        try:
            got, wanted, different, a, b = compare(session, database, query, folder)
        except Exception as problem:
            bad.append(query)
            print(f"{query:32} ERROR {type(problem).__name__}: {str(problem)[:1500]}", flush=True)
            continue
        fine = len(got) == len(wanted) and not different
        print(f"{query:32} {'ok ' if fine else 'BAD'} {len(got):7} {len(wanted):7} {len(different):6} {a:6.1f}s {b:6.1f}s", flush=True)
        if not fine:
            bad.append(query)
            for pair in different[:3]:
                print("   spark", pair[0], "\n   sql  ", pair[1])
    print("bad:", bad)
