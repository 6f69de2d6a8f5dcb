from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from varloom.fixtures import BASE_TABLES
from varloom.session import build_session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "varloom-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.checkpoint.dir": str(folder / "checkpoint"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for name in BASE_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    yield con
    con.close()


def rows(df, *order):
    """Rows as sorted tuples."""
    out = [tuple(r) for r in (df.select(*order) if order else df).collect()]
    return sorted(out, key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])
