"""Run a registered query and its SQL counterpart and compare all values."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is not None, str(type(v).__name__), v if not isinstance(v, (list, dict)) else str(v)) for v in row)


def _clean(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def rows_of_spark(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    table = df.select(*[f"`{c}`" for c in names]).toArrow().to_pydict()
    return names, sorted((tuple(_clean(v) for v in row) for row in zip(*table.values())), key=_key)


def rows_of_duck(con, sql: str) -> tuple[list[str], list[tuple]]:
    table = con.execute(sql).to_arrow_table()
    names = sorted(table.column_names)
    data = table.select(names).to_pydict()
    return names, sorted((tuple(_clean(v) for v in row) for row in zip(*data.values())), key=_key)


def differences(spark_side, duck_side, limit: int = 5) -> list[str]:
    (sn, sr), (dn, dr) = spark_side, duck_side
    if sn != dn:
        return [f"columns differ: {sorted(set(sn) ^ set(dn))}"]
    if len(sr) != len(dr):
        return [f"row counts differ: {len(sr)} and {len(dr)}"]
    out, count = [], 0
    for a, b in zip(sr, dr):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            count += 1
            if len(out) < limit:
                out.append(str([(c, x, y) for c, x, y in zip(sn, a, b) if x != y or type(x) is not type(y)][:4]))
    return [f"{count} rows differ", *out] if count else []
