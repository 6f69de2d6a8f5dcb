"""Parts for trainers are stored with their draws."""

from tests.conftest import rows
from varloom.operators import learning as L


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_split_keeps_its_draws(spark):
    """The parts are those of the plain split, and reading them hashes nothing again."""
    points = L.assemble(spark.range(200).selectExpr("id", "id % 2 AS label", "id * 1.5 AS f"), ["f"], keep=["id"])
    plain, stored = L.split_data(points, key=["id"]), L.stage_split(points, key=["id"])
    for a, b in zip(plain, stored, strict=True):
        assert a.columns == b.columns and rows(a, "id") == rows(b, "id")
        assert "md5" not in _plan(b)
