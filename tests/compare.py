"""Compare registered queries with their SQL in DuckDB.

Run as a script: ``python tests/compare.py SF_DIR [query ...]``.
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(spark, con, sf_dir, query, sql) -> str | None:
    frame = query(spark, sf_dir)
    ours = bag(frame.columns, frame.collect())
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    theirs = bag(names, found.fetchall())
    if ours == theirs:
        kinds = dict(zip(names, [str(d[1]) for d in found.description], strict=True))
        spark_kinds = {f.name: f.dataType.simpleString() for f in frame.schema}
        for name in names:
            if not same_kind(spark_kinds[name], kinds[name]):
                return f"type of {name}: {spark_kinds[name]} != {kinds[name]}"
        return None if ours else "no rows"
    extra, missing = ours - theirs, theirs - ours
    return (
        f"{sum(ours.values())} rows, expected {sum(theirs.values())}; "
        f"extra {list(extra.items())[:3]}, missing {list(missing.items())[:3]}"
    )


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT", "string": "VARCHAR",
    "double": "DOUBLE", "float": "FLOAT", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
    "binary": "BLOB",
}


def same_kind(ours: str, theirs: str) -> bool:
    if ours.startswith("decimal"):
        return theirs.upper() == ours.upper()
    return KINDS.get(ours) == theirs


if __name__ == "__main__":
    import __spark_entry__ as spark_entry
    from feedfold.session import local_session

    directory, wanted = sys.argv[1], sys.argv[2:]
    session, connection = local_session(os.environ.get("TEST_CPUS", "8")), connect(directory)
    all_sql = spark_entry.oracle_sql()
    bad = 0
    for label, run in spark_entry.queries().items():
        if wanted and label not in wanted:
            continue
        start = time.time()
        try:
            if label in all_sql:
                problem = differences(session, connection, directory, run, all_sql[label])
            else:
                problem = None if run(session, directory).count() >= 0 else "?"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{label:24s} {time.time() - start:6.2f}s {'ok' if problem is None else problem}", flush=True)
    sys.exit(bad > 0)
