"""Run registered queries and their check SQL on the same parquet files.

``python tests/compare.py [--sf 0.01] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def kinds(arrow_schema) -> dict[str, str]:
    """Column types with the unit and nullability details left out."""
    return {f.name: str(f.type).split("[")[0].replace("large_", "") for f in arrow_schema}


def differences(spark_df, con, sql: str) -> tuple[str, int]:
    ours = spark_df.toArrow()
    theirs = con.sql(sql).to_arrow_table()
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return f"columns {ours.column_names} / {theirs.column_names}", ours.num_rows
    names = sorted(ours.column_names)
    a, b = kinds(ours.schema), kinds(theirs.schema)
    if a != b:
        return f"types { {n: (a[n], b[n]) for n in names if a[n] != b[n]} }", ours.num_rows
    left = ours.select(names).to_pandas().sort_values(names).reset_index(drop=True)
    right = theirs.select(names).to_pandas().sort_values(names).reset_index(drop=True)
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}", len(left)
    for n in names:
        off = ~((left[n] == right[n]) | (left[n].isna() & right[n].isna()))
        if off.any():
            return f"{off.sum()} values of {n}: {left[off].head(3)} / {right[off].head(3)}", len(left)
    return "", len(left)


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tastemill.session import build_session

    args = sys.argv[1:]
    scale = "0.01"
    if args[:1] == ["--sf"]:
        scale, args = args[1], args[2:]
    folder = f"/root/testdata/sf{scale}"
    spark = build_session(8, **{"spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    todo, checks = queries(), oracle_sql()
    bad = 0
    for name in args or todo:
        start = time.time()
        try:
            if name in checks:
                problem, rows = differences(todo[name](spark, folder), con, checks[name])
            else:
                rows, problem = todo[name](spark, folder).count(), ""
        except Exception as error:  # a failing query must not hide the others
            problem, rows = f"{type(error).__name__}: {str(error)[:1500]}", -1
        bad += bool(problem)
        mark = "FAIL" if problem else ("ok  " if name in checks else "rows")
        print(f"{mark} {name} {rows} rows {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{bad} failing")
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
