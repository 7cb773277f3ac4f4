"""Run registered queries and their SQL side by side."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SAMPLES = Path("/root/testdata")


def sql_session(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def normalised(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([row[i] for i in order]) for row in rows)


TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


def difference(runner, sql: str, spark, con, folder: str) -> str | None:
    """None when both sides agree exactly, else what differs."""
    df = runner(spark, folder)
    got_names, got = normalised(df.columns, [tuple(r) for r in df.collect()])
    done = con.execute(sql)
    want_names, want = normalised([d[0] for d in done.description], done.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    types = dict(df.dtypes)
    for name, kind, *_ in done.description:
        if types[name] != TYPES.get(str(kind)):
            return f"type of {name}: {types[name]} != {kind}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows"
    for mine, theirs in zip(got, want, strict=True):
        if mine != theirs:
            return f"\n  spark {mine}\n  sql   {theirs}"
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from parcelledger.session import local_session

    folder = str(SAMPLES / sys.argv[1])
    wanted = sys.argv[2:]
    spark, con, statements = local_session(8), sql_session(folder), oracle_sql()
    failed = 0
    for name, runner in queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            if name in statements:
                found = difference(runner, statements[name], spark, con, folder)
            else:
                found = f"rows only: {runner(spark, folder).count()}"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:900]}"
        failed += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print("not equal:", failed)
