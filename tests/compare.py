"""Run registered queries next to their reference SQL and compare rows.

    python tests/compare.py [scale] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    return repr(value) if isinstance(value, (str, bytes)) else str(value)


def canonical(columns: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(row[i]) for i in order) for row in rows)


# Column types that count as the same in both engines.
SAME_TYPE = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def type_difference(df, con, sql: str) -> str | None:
    ours = {n: SAME_TYPE.get(t, t) for n, t in df.dtypes}
    theirs = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    wrong = {n: (t, theirs.get(n)) for n, t in ours.items() if theirs.get(n) != t}
    return f"types differ: {wrong}" if wrong else None


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql: str):
    done = con.execute(sql)
    return canonical([d[0] for d in done.description], done.fetchall())


def difference(ours, theirs) -> str | None:
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows != {len(theirs[1])} rows"
    wrong = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    if wrong:
        first = [(n, x[:200], y[:200]) for n, x, y in zip(ours[0], *wrong[0]) if x != y]
        return f"{len(wrong)} rows differ, first: {first}"
    return None


def main() -> int:
    from tests.conftest import make_session

    import __spark_entry__ as entry

    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{scale}"
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    spark, con = make_session(), database(sf_dir)
    bad = []
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            ours = spark_rows(df)
            took = time.time() - start
            if name in oracles:
                start = time.time()
                note = difference(ours, sql_rows(con, oracles[name])) or type_difference(df, con, oracles[name])
                note = note or f"equal (sql {time.time() - start:.1f}s)"
            else:
                note = "rows only"
        except Exception as error:
            took, ours, note = time.time() - start, ([], []), f"{type(error).__name__}: {str(error)[:700]}"
        if not note.startswith(("equal", "rows only")):
            bad.append(name)
        print(f"{name:26s} {len(ours[1]):7d} rows {took:6.2f}s  {note}", flush=True)
    print("failed:", bad or "none")
    spark.stop()
    return bool(bad)


if __name__ == "__main__":
    raise SystemExit(main())
