"""Compare a Spark result with a DuckDB result, order-insensitively."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(folder) / name}.parquet'")
    return con


def _plain(value):
    if value is None:
        return ("null",)
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, float):
        return ("null",) if math.isnan(value) else ("n", repr(value + 0.0))
    if isinstance(value, int):
        return ("i", repr(value))
    return ("s", str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


_FAMILY = {
    "bigint": "int", "int": "int", "smallint": "int", "tinyint": "int", "integer": "int",
    "double": "float", "float": "float", "string": "str", "varchar": "str", "boolean": "bool",
    "timestamp_ntz": "ts", "timestamp": "ts", "date": "date",
}


def compare(df, con, sql) -> tuple[list[str], int]:
    """Differences found (empty when equal) and the number of rows."""
    problems = []
    relation = con.sql(sql)
    spark_columns, duck_columns = df.columns, list(relation.columns)
    if sorted(spark_columns) != sorted(duck_columns):
        return [f"columns {sorted(spark_columns)} vs {sorted(duck_columns)}"], 0
    spark_types = {f.name: f.dataType.simpleString().split("(")[0] for f in df.schema}
    duck_types = {c: str(t).lower().split("(")[0] for c, t in zip(relation.columns, relation.types)}
    for name in spark_columns:
        left, right = _FAMILY.get(spark_types[name]), _FAMILY.get(duck_types[name])
        if left is None or left != right or (left == "int" and spark_types[name] != duck_types[name].replace("integer", "int")):
            problems.append(f"type of {name}: {spark_types[name]} vs {duck_types[name]}")
    left = rows_of(spark_columns, [tuple(r) for r in df.collect()])
    right = rows_of(duck_columns, relation.fetchall())
    if len(left) != len(right):
        problems.append(f"rows {len(left)} vs {len(right)}")
    if left != right:
        only_left = sorted(set(left) - set(right))[:3]
        only_right = sorted(set(right) - set(left))[:3]
        problems.append(f"values differ:\n   spark {only_left}\n   duck  {only_right}")
    return problems, len(left)
