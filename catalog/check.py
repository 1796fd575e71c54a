"""Run every registered query against its SQL: python -m catalog.check [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time

import duckdb

from catalog.oracles import oracles
from catalog.queries import QUERIES
from textmill.session import get_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows_of(table) -> tuple[list[str], list[tuple]]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, sorted(zip(*columns), key=repr)


def compare(spark, con, sf_dir: str, query, sql: str) -> tuple[bool, str]:
    start = time.time()
    got_names, got = rows_of(query(spark, sf_dir).toArrow())
    mine = time.time() - start
    want_names, want = rows_of(con.sql(sql).to_arrow_table())
    if got_names != want_names:
        return False, f"columns {got_names} / {want_names}"
    if got != want:
        odd = sorted(set(map(repr, got)) ^ set(map(repr, want)))[:6]
        return False, f"rows {len(got)} / {len(want)}: {[o[:200] for o in odd]}"
    return True, f"{len(got)} rows, Spark {mine:.1f}s"


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(QUERIES)
    spark = get_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(sf_dir), oracles()
    for name in chosen:
        start = time.time()
        try:
            if name in sql:
                ok, note = compare(spark, con, sf_dir, QUERIES[name], sql[name])
                state = "ok  " if ok else "FAIL"
            else:
                state, note = "rows", f"{QUERIES[name](spark, sf_dir).count()} rows"
        except Exception as e:
            state, note = "ERR ", str(e).strip()[:600]
        print(f"{state} {name:36s} {time.time() - start:6.1f}s {note}", flush=True)


if __name__ == "__main__":
    main()
