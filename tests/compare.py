"""Run a registered query in Spark and its SQL in DuckDB and compare the results row by row."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, decimal.Decimal):
        return round(float(value), 9) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    named = [columns[i] for i in order]
    return named, sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


KINDS = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "array<int>": "INTEGER[]", "array<string>": "VARCHAR[]", "array<double>": "DOUBLE[]",
    "array<array<string>>": "VARCHAR[][]", "timestamp": "TIMESTAMP",
}


def difference(spark, con, run, sql: str, sf_dir: str) -> str | None:
    """None when both agree in columns, types and values, else what differs."""
    df = run(spark, sf_dir)
    mine_cols, mine = rows_of(df.columns, df.collect())
    found = con.execute(sql)
    their_types = {d[0]: str(d[1]) for d in found.description}
    their_cols, theirs = rows_of([d[0] for d in found.description], found.fetchall())
    if mine_cols != their_cols:
        return f"columns {mine_cols} and {their_cols}"
    for f in df.schema.fields:
        expected = KINDS.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
        if their_types[f.name] != expected:
            return f"type of {f.name}: {f.dataType.simpleString()} and {their_types[f.name]}"
    if len(mine) != len(theirs):
        return f"{len(mine)} and {len(theirs)} rows"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(mine)} rows differ, first {wrong[0]}"
    if not mine:
        return "no rows"
    return None


def main(sf_dir: str, names: list[str]) -> None:
    sys.path.insert(0, ".")
    import __spark_entry__ as e
    from conftest import session

    spark, con = session(), connect(sf_dir)
    bad = 0
    for name, run in e.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            if name in e.oracle_sql():
                result = difference(spark, con, run, e.oracle_sql()[name], sf_dir)
            else:
                result = None if run(spark, sf_dir).count() else "no rows"
        except Exception as error:  # report and go on with the next query
            result = f"{type(error).__name__}: {str(error)[:600]}"
        bad += result is not None
        print(f"{'ok ' if result is None else 'BAD'} {name} {time.time() - start:.1f}s {result or ''}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
