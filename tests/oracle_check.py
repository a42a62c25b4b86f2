"""Run queries against their SQL in DuckDB: python tests/oracle_check.py [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of_spark(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(row[n] for n in names) for row in df.collect())


def rows_of_sql(con, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    return [columns[i] for i in order], rows


def differences(df, con, sql: str) -> str | None:
    """None if both give the same columns and rows, else a short description."""
    names, mine = rows_of_spark(df)
    sql_names, theirs = rows_of_sql(con, sql)
    if names != sql_names:
        return f"columns {names} and {sql_names}"
    if mine == theirs:
        return None
    only_mine, only_theirs = mine - theirs, theirs - mine
    return (
        f"{mine.total()} and {theirs.total()} rows; only Spark {only_mine.total()}, e.g. "
        f"{dict(zip(names, next(iter(only_mine), ())))}; only SQL {only_theirs.total()}, e.g. "
        f"{dict(zip(names, next(iter(only_theirs), ())))}"
    )


def main() -> None:
    from session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    con = connect(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            found = differences(df, con, sql[name])
            n = df.count()
        except Exception as error:  # keep going to see every failing query
            found, n = f"{type(error).__name__}: {str(error)[:1500]}", -1
        verdict = "same" if found is None else f"DIFFERENT: {found}"
        print(f"{name} [{n} rows, {time.time() - start:.1f}s] {verdict}", flush=True)


if __name__ == "__main__":
    main()
