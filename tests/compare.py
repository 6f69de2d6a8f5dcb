"""Runs queries against their SQL oracles: ``python tests/compare.py SF_DIR [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def as_bag(names, rows) -> Counter:
    """Rows with columns in name order, as a multiset of text."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


ALIASES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE",
}


def compare(spark, duck, run, oracle: str | None, sf_dir: str) -> tuple[str, int]:
    """('ok' or what differs, row count)."""
    df = run(spark, sf_dir)
    ours = [tuple(r) for r in df.collect()]
    if oracle is None:
        return ("rows only", len(ours))
    result = duck.execute(oracle)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    theirs = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return (f"columns {sorted(df.columns)} != {sorted(names)}", len(ours))
    wrong = {f.name: (f.dataType.simpleString(), kinds[f.name]) for f in df.schema.fields
             if ALIASES.get(f.dataType.simpleString()) != kinds[f.name]}
    a, b = as_bag(df.columns, ours), as_bag(names, theirs)
    if a != b:
        extra, missing = a - b, b - a
        return (f"{len(ours)} != {len(theirs)} rows; extra {list(extra.items())[:2]} missing {list(missing.items())[:2]}", len(ours))
    return (f"types {wrong}" if wrong else "ok", len(ours))


if __name__ == "__main__":
    import duckdb

    import __spark_entry__ as entry
    from varloom.fixtures import BASE_TABLES
    from varloom.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    duck = duckdb.connect()
    for table in BASE_TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    spark = build_session(
        "compare", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or runs:
        began = time.time()
        try:
            verdict, n = compare(spark, duck, runs[name], oracles.get(name), sf_dir)
        except Exception as error:  # noqa: BLE001
            verdict, n = f"{type(error).__name__}: {str(error)[:900]}", -1
        bad += verdict not in ("ok", "rows only")
        print(f"{time.time() - began:6.2f}s {name:28s} {n:8d} {verdict}", flush=True)
    print(f"{len(names or runs)} queries, {bad} bad")
    spark.stop()
