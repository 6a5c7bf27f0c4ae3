"""Queries give their whole result: every row of the tables, not a part of it."""

import re
import shutil

import duckdb
import pytest

from tests.conftest import SF
from weftline import cli
from weftline.pipeline import table_digest
from weftline.plans import catalog


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in SF.glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_published_tags_are_all_active_tags(spark, con):
    active = con.sql("SELECT count(*) FROM tags WHERE state = 'active'").fetchall()[0][0]
    rows = catalog.QUERIES["published_tags"](spark, str(SF)).collect()
    order = [(-r["prevalence"], -r["support"], r["tag_id"]) for r in rows]
    assert len(rows) == active > 200 and order == sorted(order)


def test_every_vector_is_mapped_as_a_term(spark, con):
    terms = {r["term_id"] for r in catalog.QUERIES["term_tag_mapping"](spark, str(SF)).select("term_id").collect()}
    assert terms == {r[0] for r in con.sql("SELECT vec_id FROM embeddings").fetchall()}


def test_combined_vectors_have_all_their_dimensions(spark, con):
    values = con.sql("SELECT sum(len(embedding))::BIGINT FROM embeddings").fetchall()[0][0]
    assert catalog.QUERIES["combined_vector"](spark, str(SF)).count() == values


def test_all_deliveries_are_normalised(spark, con):
    days = {r["delivery"] for r in catalog.QUERIES["normalize_raw"](spark, str(SF)).select("delivery").collect()}
    assert len(days) == 6 and days == {r[0] for r in con.sql("SELECT DISTINCT substr(source_last_updated, 1, 10) FROM companies_raw").fetchall()}


def test_no_sql_is_cut():
    """Limits only where the number is what is asked for: pages, pickers, samples, the top of a report."""
    asked = {"result_page", "picker", "prevalence_top", "stratified_sample", "search_tiers", "filter_full", "quality_details"}
    for name, sql in catalog.ORACLES.items():
        outer = re.sub(r"ORDER BY s LIMIT 5", "", sql)  # the samples of a gate
        assert name in asked or "LIMIT" not in outer, name
        assert not re.search(r"% \d+ = 0\)? *(?:$|AND|\))", sql.split("WHERE")[-1]) or name in ("keep_last_success", "shortlist_rules"), name


def test_stages_run_again_when_a_source_or_a_setting_changes(spark, tmp_path, capsys, monkeypatch):
    data, out = tmp_path / "data", str(tmp_path / "out")
    data.mkdir()
    for name in ("companies_raw", "company_tag_judgments", "source_taxonomy_terms"):
        shutil.copy(SF / f"{name}.parquet", data)

    stages = ["fetch", "assign-features"]

    def fresh() -> list[str]:
        for name in stages:
            assert cli.main([name, "--data", str(data), "--out", out]) == 0
        return [line.split()[0] for line in capsys.readouterr().out.splitlines() if line.endswith("is fresh")]

    def more(name: str) -> None:
        both = spark.read.parquet(str(SF / f"{name}.parquet"))
        both.union(both.limit(1)).coalesce(1).write.parquet(str(tmp_path / "new"))
        (data / f"{name}.parquet").unlink()
        shutil.move(next((tmp_path / "new").glob("*.parquet")), data / f"{name}.parquet")
        shutil.rmtree(tmp_path / "new")

    assert fresh() == [] and fresh() == stages
    more("companies_raw")
    assert fresh() == ["assign-features"] and fresh() == stages
    more("source_taxonomy_terms")
    assert fresh() == ["assign-features"]
    more("company_tag_judgments")
    assert fresh() == ["fetch"] and fresh() == stages
    monkeypatch.setenv("WEFTLINE_MIN_CONFIDENCE", "0.9")
    assert fresh() == []
    assert spark.read.parquet(f"{out}/runs.parquet").groupBy("stage").count().count() == 2


def test_table_digest_is_of_the_content(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "a"), (2, None, "a")], "i int, x string, y string")
    same = table_digest(df)
    assert table_digest(df.repartition(3, "i")) == same
    assert table_digest(df.distinct()) != same and table_digest(df.select("i", df.y.alias("x"), df.x.alias("y"))) != same and table_digest(df.limit(0)) != same
