"""Run queries next to their SQL and compare: python -m checks.compare SF_DIR [name ...]"""

from __future__ import annotations

import sys
import time

import duckdb

from checks.catalog import QUERIES
from checks.oracles import SQL
from heatmart.session import session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def rows_of(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    """Columns in name order, rows in a stable order."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(r[i] for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def compare(spark, con, name: str, sf_dir: str, inspect=None) -> str:
    """Verdict on one query; ``inspect`` may look at its DataFrame first."""
    df = QUERIES[name](spark, sf_dir)
    if inspect:
        inspect(df)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in SQL:
        return f"rows {len(mine[1])}"
    found = con.execute(SQL[name])
    theirs = rows_of([d[0] for d in found.description], found.fetchall())
    if mine[0] != theirs[0]:
        return f"COLUMNS {mine[0]} / {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"COUNT {len(mine[1])} / {len(theirs[1])}"
    types = [{type(v).__name__ for v in c if v is not None} for c in zip(*mine[1])]
    other = [{type(v).__name__ for v in c if v is not None} for c in zip(*theirs[1])]
    if types != other:
        return f"TYPES {[(n, a, b) for n, a, b in zip(mine[0], types, other) if a != b]}"
    wrong = [(a, b) for a, b in zip(*(mine[1], theirs[1])) if a != b]
    if wrong:
        return f"VALUES {len(wrong)} of {len(mine[1])}, first {mine[0]} {wrong[0]}"
    return f"ok {len(mine[1])}"


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = session("compare", "local[8]", {"spark.sql.shuffle.partitions": "8",
                                            "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            verdict = compare(spark, con, name, sf_dir)
        except Exception as error:
            verdict = f"ERROR {str(error)[:600]}"
        bad += not verdict.startswith(("ok", "rows"))
        print(f"{name:26} {time.time() - start:6.2f}s {verdict}", flush=True)
    print(f"{bad} differ; without SQL: {sorted(set(QUERIES) - set(SQL))}; "
          f"SQL only: {sorted(set(SQL) - set(QUERIES))}")
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
