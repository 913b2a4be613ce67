"""Run registered queries next to their SQL oracles: ``python tests/compare.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as registry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if hasattr(v, "item"):
        v = v.item()
    return float(v) if isinstance(v, (int, float)) else v


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """None if both sides return the same columns and exactly the same values."""
    got = registry.queries()[name](spark, sf_dir)
    mine = _rows(got.columns, [tuple(r) for r in got.collect()])
    cursor = con.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    theirs = _rows(columns, cursor.fetchall())
    if sorted(columns) != sorted(got.columns):
        return f"columns {sorted(got.columns)} vs {sorted(columns)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows vs {len(theirs)}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(wrong)} of {len(mine)} rows differ, e.g. {wrong[0]}" if wrong else None


def main() -> None:
    from cohortix.session import build_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(registry.queries())
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
                                         "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in names:
        start = time.time()
        if name in registry.oracle_sql():
            problem = difference(spark, con, name, sf_dir)
        else:
            problem = f"no oracle, {registry.queries()[name](spark, sf_dir).count()} rows"
        print(f"{'ok  ' if problem is None else '--- '} {name:28s} {time.time() - start:6.2f}s {problem or ''}", flush=True)


if __name__ == "__main__":
    main()
