"""Run a query on Spark and its SQL form on DuckDB, and compare the two results."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _kinds(table) -> dict[str, str]:
    return {f.name: str(f.type).replace("large_", "").replace("timestamp[ns]", "timestamp[us]") for f in table.schema}


def _rows(table) -> list[tuple]:
    columns = [table.column(c).to_pylist() for c in sorted(table.column_names)]
    return sorted(zip(*columns), key=repr) if columns else []


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty when names, types and rows agree."""
    ours, theirs = spark_df.toArrow(), con.sql(sql).to_arrow_table()
    problems = []
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return [f"columns {sorted(ours.column_names)} != {sorted(theirs.column_names)}"]
    a, b = _kinds(ours), _kinds(theirs)
    problems += [f"type of {c}: {a[c]} != {b[c]}" for c in a if a[c] != b[c]]
    if ours.num_rows != theirs.num_rows:
        return [*problems, f"rows {ours.num_rows} != {theirs.num_rows}"]
    left, right = _rows(ours), _rows(theirs)
    wrong = [(x, y) for x, y in zip(left, right) if repr(x) != repr(y)]
    if wrong:
        problems.append(f"{len(wrong)} of {len(left)} rows differ, first {wrong[0]}")
    return problems


def main() -> None:
    from sievework.session import build_session
    from workload.registry import ORACLES, QUERIES

    sf_dir = sys.argv[1]
    chosen = sys.argv[2:] or list(QUERIES)
    spark = build_session("oracle", "local[8]", 8, {"spark.ui.enabled": "false", "spark.log.level": "ERROR",
                                                   "spark.ui.showConsoleProgress": "false"})
    con = connect(sf_dir)
    bad = 0
    for name in chosen:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                problems = differences(df, con, ORACLES[name])
                note = f"{len(df.columns)} columns"
            else:
                problems, note = [], f"{df.count()} rows, no SQL form"
        except Exception as e:  # report and go on
            problems, note = [f"{type(e).__name__}: {str(e)[:600]}"], ""
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.2f}s {note} {problems or ''}", flush=True)
    print(f"{bad} failed of {len(chosen)}")


if __name__ == "__main__":
    main()
