"""Compare registered queries with their SQL on a test scale: ``python tests/oracle_check.py [sf] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def canonical(rows: list[tuple], names: list[str]) -> list[tuple]:
    """Rows as sorted text tuples, columns in name order."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple("" if row[i] is None else f"={row[i]}" for i in order) for row in rows)


_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> tuple[bool, int, str]:
    frame = query(spark, sf_dir)
    got = [tuple(row) for row in frame.collect()]
    found = con.sql(sql)
    names, types = list(found.columns), [str(t) for t in found.types]
    want = found.fetchall()
    if sorted(frame.columns) != sorted(names):
        return False, len(got), f"columns {sorted(frame.columns)} != {sorted(names)}"
    mine = {f.name: f.dataType.simpleString() for f in frame.schema}
    mine = {name: _TYPES.get(type_, type_.upper()) for name, type_ in mine.items()}
    if mine != dict(zip(names, types)):
        return False, len(got), f"types {sorted(set(mine.items()) ^ set(zip(names, types)))}"
    left, right = canonical(got, frame.columns), canonical(want, names)
    if left == right:
        return True, len(got), ""
    extra = sorted(set(left) - set(right))[:2]
    lack = sorted(set(right) - set(left))[:2]
    return False, len(got), f"rows {len(left)} != {len(right)}\n   spark  {extra}\n   oracle {lack}"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries

    from tillhouse.session import local_session

    args = sys.argv[1:]
    sf_dir = f"/root/testdata/sf{args[0] if args else '0.01'}"
    names = args[1:] or list(queries())
    spark, con = local_session(8), connect(sf_dir)
    failed = []
    for name in names:
        start = time.time()
        try:
            ok, rows, note = compare(spark, con, name, queries()[name], oracle_sql()[name], sf_dir)
        except Exception as error:  # noqa: BLE001 - report and go on
            ok, rows, note = False, -1, f"{type(error).__name__}: {str(error)[:700]}"
        print(f"{'ok  ' if ok else 'FAIL'} {name} rows={rows} {time.time() - start:.1f}s {note}", flush=True)
        if not ok:
            failed.append(name)
    print(f"{len(names) - len(failed)}/{len(names)} equal; failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
