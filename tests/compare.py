"""Compare a Spark result with a DuckDB result as unordered sets of typed rows."""

from pathlib import Path

import duckdb

SMALL = "/root/testdata/sf0.001"

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
# Spark type -> the DuckDB type it must meet.
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def differences(df, con, sql: str) -> list[str]:
    """What differs: columns, types, row count, rows. Empty when they agree."""
    relation = con.sql(sql)
    expected_types = dict(zip(relation.columns, map(str, relation.types)))
    found_types = {name: TYPES[kind] for name, kind in df.dtypes}
    if found_types != expected_types:
        return [f"schema: spark {sorted(found_types.items())} sql {sorted(expected_types.items())}"]
    expected = _rows(relation.columns, relation.fetchall())
    found = _rows(df.columns, [tuple(row) for row in df.collect()])
    if len(found) != len(expected):
        return [f"rows: spark {len(found)} sql {len(expected)}"]
    bad = [(a, b) for a, b in zip(found, expected) if a != b]
    return [f"{len(bad)} rows differ, first: spark {bad[0][0]} sql {bad[0][1]}"] if bad else []
