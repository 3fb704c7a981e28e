"""Run registered queries and their SQL side by side: python -m checks.compare DIR [names]."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pyarrow as pa

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import checks.language  # noqa: E402, F401
import checks.model_queries  # noqa: E402, F401
import checks.more_queries  # noqa: E402, F401
from checks.oracles import ORACLES  # noqa: E402
from checks.workload import QUERIES  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def rows_of(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*columns), key=repr)


def types_of(table: pa.Table) -> dict[str, str]:
    plain = {"large_string": "string"}
    return {f.name: plain.get(str(f.type), str(f.type)) for f in sorted(table.schema, key=lambda f: f.name)}


def compare(spark, con, folder: str, name: str) -> tuple[bool, str]:
    start = time.time()
    ours = QUERIES[name](spark, folder).toArrow()
    took = time.time() - start
    start = time.time()
    theirs = con.execute(ORACLES[name]).to_arrow_table()
    note = f"{ours.num_rows} rows, spark {took:.2f}s, duckdb {time.time() - start:.2f}s"
    if types_of(ours) != types_of(theirs):
        return False, f"{note}; types {types_of(ours)} / {types_of(theirs)}"
    a, b = rows_of(ours), rows_of(theirs)
    if a != b:
        first = next(((x, y) for x, y in zip(a, b) if x != y), None)
        wrong = sum(x != y for x, y in zip(a, b))
        return False, f"{note}; {len(a)} / {len(b)} rows, {wrong} differ, first {str(first)[:900]}"
    return True, note


def main(folder: str, names: list[str]) -> int:
    from penprint.session import build_session

    spark = build_session("compare", 8)
    con = connect(folder)
    bad = 0
    for name in names or [n for n in QUERIES if n in ORACLES]:
        try:
            good, note = compare(spark, con, folder, name)
        except Exception as error:  # report and go on with the next query
            good, note = False, str(error)[:900].replace("\n", " | ")
        bad += not good
        print(("ok   " if good else "WRONG"), f"{name:24s}", note, flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
