"""Run every registered query next to its SQL and compare the results row by row.

    python -m checks.compare [sf_dir] [name ...]
"""

import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


SPARK_TYPES = {
    "VARCHAR": "string",
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


def same(expected_types, expected_rows, df):
    """None when equal, otherwise what differs. Types count as well as values."""
    expected_names = list(expected_types)
    wanted = {name: SPARK_TYPES.get(kind, kind) for name, kind in expected_types.items()}
    if wanted != dict(df.dtypes):
        return f"columns {dict(df.dtypes)} instead of {wanted}"
    rows = Counter(tuple(row) for row in df.select(*expected_names).collect())
    expected = Counter(tuple(row) for row in expected_rows)
    if rows == expected:
        return None
    missing, extra = expected - rows, rows - expected
    return (
        f"{sum(rows.values())} rows, {sum(expected.values())} expected; "
        f"missing {list(missing)[:2]}, unexpected {list(extra)[:2]}"
    )


def check(spark, sf_dir, connection, name, build, sql):
    types = {row[0]: row[1] for row in connection.execute(f"DESCRIBE {sql}").fetchall()}
    return same(types, connection.execute(sql).fetchall(), build(spark, sf_dir))


def main(sf_dir="/root/testdata/sf0.01", *names):
    from checks.oracle import ORACLES
    from checks.queries import QUERIES
    from waybill.session import build_session

    spark = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failures = 0
    for name, build in QUERIES.items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            difference = check(spark, sf_dir, connection, name, build, ORACLES[name])
        except Exception as error:  # noqa: BLE001 - the run goes on and reports it
            difference = f"{type(error).__name__}: {str(error)[:600]}"
        failures += difference is not None
        print(f"{time.time() - began:6.2f}s {name}: {difference or 'equal'}", flush=True)
    print(f"{failures} of {len(names or QUERIES)} differ")
    return failures


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
