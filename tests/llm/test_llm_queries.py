"""Every query of the subpackage with SQL against DuckDB on the smallest tables, and the others for what they promise."""

import duckdb
import pytest

from tests.conftest import SF
from verify import compare
from weftline.llm import queries


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in SF.glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_its_sql(spark, con, name):
    said = compare(spark, con, name, str(SF))
    assert said.startswith("ok"), said


def test_the_outcome_is_that_of_the_sample(spark):
    drawn = {r["cell_id"]: r["count"] for r in queries.p4_sample(spark, str(SF)).groupBy("cell_id").count().collect()}
    for r in queries.p4_outcome(spark, str(SF)).collect():
        assert r["drawn"] == drawn.get(r["cell_id"], 0) and r["unmet"] == max(0, r["need"] - r["drawn"]) and (r["reason"] is None) == (r["unmet"] == 0)
