"""Run registered queries next to their oracle SQL and report differences.

    python tests/compare.py SF_DIR [NAME_PART ...]
"""

from __future__ import annotations

import decimal
import math
import sys
import time
import traceback
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle(sf: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


def plain(value: object) -> object:
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    return value


_KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
    "BOOLEAN": "boolean", "DATE": "date",
}


def differences(frame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:  # noqa: ANN001
    """What differs between a Spark frame and an oracle query; empty when equal."""
    names = sorted(frame.columns)
    relation = connection.sql(sql)
    problems = []
    if sorted(relation.columns) != names:
        return [f"columns {names} != {sorted(relation.columns)}"]
    kinds = dict(frame.dtypes)
    for name, kind in zip(relation.columns, relation.types, strict=True):
        if _KINDS.get(str(kind)) != kinds[name]:
            problems.append(f"type of {name}: {kinds[name]} != {kind}")
    ours = sorted((tuple(plain(r[n]) for n in names) for r in frame.collect()), key=repr)
    order = [relation.columns.index(n) for n in names]
    theirs = sorted(
        (tuple(plain(r[i]) for i in order) for r in relation.fetchall()), key=repr
    )
    if len(ours) != len(theirs):
        problems.append(f"{len(ours)} rows != {len(theirs)}")
    if ours != theirs:
        left = [r for r in ours if r not in set(theirs)][:3]
        right = [r for r in theirs if r not in set(ours)][:3]
        problems.append(f"spark only {left}\n      oracle only {right}")
    return problems


def main() -> int:
    import __spark_entry__ as entry
    from docloom.session import local_session

    sf, parts = sys.argv[1], sys.argv[2:]
    spark = local_session("compare")
    connection = oracle(sf)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, function in queries.items():
        if parts and not any(p in name for p in parts):
            continue
        started = time.time()
        try:
            frame = function(spark, sf)
            if name in sqls:
                problems = differences(frame, connection, sqls[name])
            else:
                problems = [] if frame.count() >= 0 else ["no rows"]
            rows = frame.count() if not problems else "?"
        except Exception as error:  # noqa: BLE001
            problems = ["".join(traceback.format_exception_only(error))[:1500]]
            rows = "?"
        bad += bool(problems)
        mark = "FAIL" if problems else "ok"
        print(f"{mark:4} {name} rows={rows} {time.time() - started:.1f}s", flush=True)
        for problem in problems:
            print("     ", problem, flush=True)
    print(f"{bad} of the queries differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
