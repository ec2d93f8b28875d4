"""Run a query and its SQL side by side and compare all rows.

    python tests/oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(spark, con, fn, sql: str, sf_dir: str) -> str | None:
    """None when equal, else what differs. Types must agree, not only text."""
    df = fn(spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in cols]).collect()), key=repr)
    rel = con.sql(sql)
    if sorted(rel.columns) != cols:
        return f"columns: {cols} / {sorted(rel.columns)}"
    want = con.sql("SELECT " + ", ".join(f'"{c}"' for c in cols) + f" FROM ({sql})").fetchall()
    want = sorted(want, key=repr)
    if got == want:
        return None
    if len(got) != len(want):
        only = [r for r in got if r not in set(want)][:3], [r for r in want if r not in set(got)][:3]
        return f"rows: {len(got)} / {len(want)}; only here {only[0]}; only there {only[1]}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(bad)} of {len(got)} rows differ {cols}: {bad[:3]}"


def main() -> int:
    import __spark_entry__ as entry
    from faremeld.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session(
        "oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("OFF")
    con, sql, failed = connect(sf_dir), entry.oracle_sql(), 0
    for name in names:
        t = time.time()
        try:
            problem = compare(spark, con, entry.queries()[name], sql[name], sf_dir)
        except Exception as exc:  # noqa: BLE001
            problem = f"{type(exc).__name__}: {str(exc)[:1500]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - t:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed}/{len(names)} equal")
    return failed


if __name__ == "__main__":
    raise SystemExit(main())
