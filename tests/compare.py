"""Compare registered queries with their SQL in DuckDB: columns, types, and rows as a multiset."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def difference(df, con, sql: str) -> str | None:
    """What differs between a Spark result and a DuckDB result, None if nothing does."""
    result = con.sql(sql)
    theirs = dict(zip(result.columns, [str(x) for x in result.types]))
    ours = {c: TYPES.get(x, x.upper()) for c, x in df.dtypes}
    if ours != theirs:
        both = sorted(set(ours) | set(theirs))
        return "schema: " + ", ".join(
            f"{c} {ours.get(c)} != {theirs.get(c)}" for c in both if ours.get(c) != theirs.get(c)
        )
    names = sorted(ours)
    left = Counter(tuple(r[n] for n in names) for r in df.collect())
    order = [result.columns.index(n) for n in names]
    right = Counter(tuple(r[i] for i in order) for r in result.fetchall())
    if left != right:
        only_left, only_right = list((left - right).items()), list((right - left).items())
        return (
            f"rows: {sum(left.values())} and {sum(right.values())}, {names}\n"
            f"   only in Spark {only_left[:3]}\n   only in SQL   {only_right[:3]}"
        )
    return None


def main() -> None:
    from salesloom.catalog.queries import ORACLE, QUERIES
    from salesloom.session import build_session

    folder = f"/root/testdata/sf{sys.argv[1]}"
    wanted = sys.argv[2:]
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, build in QUERIES.items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            df = build(spark, folder)
            if name in ORACLE:
                outcome = difference(df, con, ORACLE[name])
            else:
                outcome = None
                print("   rows only:", df.count())
        except Exception as error:
            outcome = f"{type(error).__name__}: {str(error)[:600]}"
        bad += outcome is not None
        print(f"{'ok  ' if outcome is None else 'FAIL'} {name} {time.time() - started:.2f}s", outcome or "", flush=True)
    print("failed:", bad, "of", len(wanted) or len(QUERIES))


if __name__ == "__main__":
    main()
