import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF, rows
from weftline import cli
from weftline.operators import publish as B
from weftline.operators.quality import checksum_violations
from weftline.pipeline import Store, run_stage
from weftline.plans import streams
from weftline.plans.judging import finalize_last_wins
from weftline.sources import directory, files, models, schemas
from weftline.sources.tables import table


def test_jsonl(spark, tmp_path):
    schema = schemas.schema_of("tag_aliases")
    assert files.read_jsonl(spark, str(tmp_path / "none"), schema).count() == 0
    df = spark.createDataFrame([("b", "t", "B", "b", "merge", None), ("a", "t", None, "a", "merge", None)], schema)
    files.write_jsonl(df, str(tmp_path / "a"), "alias_id", files=1)
    assert rows(files.read_jsonl(spark, str(tmp_path / "a"), schema)) == rows(df)
    (tmp_path / "x.jsonl").write_text('{"alias_id":"1"}\n\nnot json\n')
    good, bad = files.read_jsonl_quarantined(spark, str(tmp_path / "x.jsonl"), schema)
    assert good.count() == 1 and rows(bad) == [("not json",)]


def test_documents_checksums_and_tampering(spark, tmp_path):
    root = f"file://{tmp_path}"
    files.write_document(spark, f"{root}/r/a.json", {"b": 1, "a": [2]})
    files.write_document(spark, f"{root}/r/manifest.json", {})
    assert (tmp_path / "r/a.json").read_text() == '{"a":[2],"b":1}' and files.read_document(spark, f"{root}/r/a.json") == {"a": [2], "b": 1}
    sums = files.release_checksums(spark, f"{root}/r")
    assert list(sums) == ["a.json"] and checksum_violations(spark, f"{root}/r", sums).count() == 0
    (tmp_path / "r/a.json").write_text("{}")
    (tmp_path / "r/.a.json.crc").unlink()  # else the file system itself refuses the changed file
    assert rows(checksum_violations(spark, f"{root}/r", sums | {"gone": "0"})) == [("a.json", "changed"), ("gone", "missing")]


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"], {"k": 1})], "n int, l array<string>, m map<string,int>")
    assert files.export_bundle({"t": df, "none": df.limit(0)}, str(tmp_path)) == {"t": 1, "none": 0}
    assert rows(spark.read.option("header", True).csv(f"{tmp_path}/t.csv")) == [("1", "a; b")]
    assert spark.read.parquet(f"{tmp_path}/none.parquet").columns == ["n", "l", "m"]


def test_matrix_round_trip(spark, tmp_path):
    f = spark.createDataFrame([("b", "y", 1.0), ("a", "x", 2.0), ("a", "y", 3.0), ("zz", "x", 9.0)], "r string, c string, v double")
    coo, ptr = B.csr_matrix(f.withColumnsRenamed({"r": "row", "c": "col"}), spark.createDataFrame([("a",), ("b",), ("c",)], "row string"), spark.createDataFrame([("x",), ("y",)], "col string"), "row", "col", "v")
    assert files.write_matrix(coo, ptr, str(tmp_path)) == 3
    assert rows(coo) == [(0, 0, 2.0), (0, 1, 3.0), (1, 1, 1.0)] and rows(ptr) == [(0, 0, 2), (1, 2, 3), (2, 3, 3)]


def test_shards_are_pruned_and_empty_ones_exist(spark, tmp_path):
    recs = spark.createDataFrame([("ycoss:1080", 44, '{"name": "N"}')], "company_id string, shard int, record string")
    files.write_details(recs, str(tmp_path / "d"))
    assert len(list((tmp_path / "d").glob("shard=*"))) == 64
    hit = files.lookup_detail(spark, str(tmp_path / "d"), "ycoss:1080")
    assert json.loads(hit.first()["record"])["name"] == "N" and "PartitionFilters: [isnotnull(shard" in hit._jdf.queryExecution().executedPlan().toString()
    assert files.lookup_detail(spark, str(tmp_path / "d"), "ycoss:1").count() == 0


def test_landed_directory(spark, tmp_path):
    (tmp_path / "all.json").write_text('[{"name":"A", "id":1},{"id":2},"x",{"id":3,"name":"C","more":[1],"tags":["t","t"]},{"id":4,"name":" "}]')
    good, bad = directory.read_landed(spark, str(tmp_path / "all.json"), prefix="p", last_updated="2026-01-01")
    assert rows(good.select("company_id", "payload")) == [("p:1", '{"id":1,"name":"A"}'), ("p:3", '{"id":3,"more":[1],"name":"C","tags":["t","t"]}')] and good.columns == schemas.schema_of("companies_raw").names
    assert rows(bad.select("error")) == [("no name",), ("no name",), ("not JSON",)]
    assert sum(x.count() for x in directory.read_landed(spark, str(tmp_path / "all.json"), limit=2)) == 2
    assert rows(directory.fixture_terms(good).select("kind", "slug", "company_count")) == [("tag", "t", 2)]
    (tmp_path / "l.jsonl").write_text('{"id":1,"name":"A"}\n\nnonsense\n')
    assert [x.count() for x in directory.read_landed(spark, str(tmp_path / "l.jsonl"), lines=True)] == [1, 1]


def test_adapters(spark):
    class Two:
        name = "two"

        def resources(self, options):
            return options["path"].split()

        def records(self, resource):
            yield {"id": resource, "name": "N"}
            yield 5

    directory.ADAPTERS["two"] = Two()
    directory.register(spark)
    got = spark.read.format("directory").option("path", "a b").option("adapter", "two").load()
    good, bad = directory.raw_rows(got, "two", "p")
    assert rows(good.select("company_id", "source_url")) == [("p:a", "a"), ("p:b", "b")] and rows(bad.select("error")) == [("not an object",)] * 2


def test_crawler(spark):
    from weftline.sources.website import Answer, crawl

    site = {
        "https://a.example/robots.txt": Answer(200, "text/plain", b"User-agent: *\nDisallow: /company"), "https://a.example/": Answer(200, "text/html", b"<title>A</title><main>Hello there</main>"), "https://a.example/about": Answer(302, location="https://www.a.example/us"), "https://www.a.example/us": Answer(200, "text/html", b"<p>About us text</p>"),
        "https://b.example/robots.txt": Answer(404), "https://b.example/": Answer(301, location="http://10.0.0.1/"), "https://b.example/about": Answer(200, "image/png", b"x"), "https://b.example/company": Answer(200, "text/html", b"y" * 50),
    }
    ips = {"a.example": ["8.8.8.8"], "www.a.example": ["8.8.8.8"], "b.example": ["8.8.4.4"], "in.example": ["10.1.1.1"]}
    df = spark.createDataFrame([("1", "https://a.example/x"), ("2", "https://b.example"), ("3", "ftp://c.example"), ("4", "https://in.example"), ("5", None)], "company_id string, website string")
    out = crawl(df, "bot", get=lambda u, agent, most: site[u], resolver=lambda h: ips.get(h, []), pause=0, most_bytes=40).collect()
    got = {(r["company_id"], r["url"].rsplit("/", 1)[-1]): (r["ok"], r["error"], r["text"]) for r in out}
    assert got["1", ""] == (True, None, "Hello there") and got["1", "about"][2] == "About us text" and got["1", "company"][1] == "disallowed by robots"
    assert got["2", ""][1] == "redirect to another site" and got["2", "about"][1] == "content type" and got["2", "company"][1] == "too large" and got["3", "c.example"][1] == "scheme" and got["4", ""][1] == "not public"


def test_models_are_cached_and_repaired(spark):
    class Flaky(models.Deterministic):
        def generate(self, prompt):
            if "Attempt 3" in prompt:
                return '{"decision": "yes"}'
            if "Attempt" in prompt:
                return '{"decision": 1}'
            raise OSError("no answer")

    req = spark.createDataFrame([("p",), ("p",), ("q",)], "prompt string")
    out = models.generate(req, None, Flaky(), "decision string", pause=0)
    assert out.count() == 2 and out.where("valid").count() == 2
    assert models.generate(req, None, Flaky(), "decision string", retries=1, pause=0).where("NOT valid AND answer IS NULL").count() == 2
    cache = out.select("key", "response", "valid")
    again = models.generate(req, cache, models.Deterministic(), "decision string")
    assert {r["response"] for r in again.collect()} == {'{"decision": "yes"}'}
    (v,) = spark.createDataFrame([("hello world",)], "t string").select(models.embed(F.col("t"), models.Deterministic(16))).first()
    assert len(v) == 16 and sum(x * x for x in v) == pytest.approx(1, abs=1e-5)
    near, far, none = models.Deterministic().embed(["red pumps for farms", "blue pumps for farms", "court records"]), models.Deterministic().embed(["court records"])[0], models.Deterministic().embed([" !"])[0]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    assert dot(near[0], near[1]) > 0.5 > abs(dot(near[0], far)) and near[2] == far and not any(none)
    texts = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "text string")
    first = models.embed_texts(texts.where("text = 'a'"), None, models.Deterministic(4))
    kept = first.select("key", F.array(*[F.lit(9.0).cast("float")] * 4).alias("vector"))
    assert sorted(r["vector"] == [9.0] * 4 for r in models.embed_texts(texts, kept, models.Deterministic(4)).collect()) == [False, True]
    assert models.resolve_model(models.Deterministic(), "deterministic") == "deterministic"
    with pytest.raises(LookupError):
        models.resolve_model(models.Deterministic(), "other")


def test_schemas_are_closed(spark):
    assert len(schemas.export_schemas()) == 18
    assert schemas.unexpected_columns(spark.range(1).withColumnRenamed("id", "nope"), "tags") == ["nope"]


def test_stages_run_once_and_again_when_an_output_is_gone(spark, tmp_path):
    ran = []

    def work():
        ran.append(1)
        spark.range(3).write.mode("overwrite").parquet(f"{tmp_path}/out.parquet")
        return {"rows": 3}

    for _ in range(2):
        run_stage(Store(spark, str(tmp_path)), "s", {"a": 1}, [], ["out.parquet"], work)
    assert len(ran) == 1
    run_stage(Store(spark, str(tmp_path)), "s", {"a": 2}, [], ["out.parquet"], work)
    run_stage(Store(spark, str(tmp_path)), "s", {"a": 2}, [], ["out.parquet", "missing"], work)
    assert len(ran) == 3


def test_command_line(spark, tmp_path, capsys):
    assert cli.main(["queries"]) == 0 and "sparse_features" in capsys.readouterr().out
    assert cli.main(["run", "--data", str(SF), "--out", str(tmp_path)]) == 0
    assert cli.main(["run", "--data", str(SF), "--out", str(tmp_path)]) == 0
    assert capsys.readouterr().out.count("is fresh") == 8
    runs = spark.read.parquet(f"{tmp_path}/runs.parquet")
    assert runs.count() == 8 and runs.where("status = 'done'").count() == 8
    assert cli.main(["search", "--out", str(tmp_path), "--name", "tenant"]) == 0 and cli.main(["migrate-ontology", "--out", str(tmp_path)]) == 0
    assert cli.main(["validate", "--out", str(tmp_path)]) == 0 and cli.main(["doctor"]) == 0


def test_tampering_fails_the_gates(spark, tmp_path, monkeypatch):
    from weftline.operators import release
    from weftline.plans import publishing

    root, counts = publishing._release(spark, str(SF))
    failed = lambda: {r["gate"] for r in release.published_gates(spark, root).where("NOT passed").collect()}
    folder = Path(release.current_release(spark, root).removeprefix("file:").replace("///", "/"))
    assert failed() == set() and counts["companies"] == counts["points"]

    def change(name, old, new):
        path = next(p for p in sorted((folder / name).glob("part-*")) if old in p.read_text())
        text = path.read_text()
        (path.parent / f".{path.name}.crc").unlink(missing_ok=True)
        path.write_text(text.replace(old, new, 1))
        return lambda: ((path.parent / f".{path.name}.crc").unlink(missing_ok=True), path.write_text(text))

    for name, old, new, gates in [("points", '"x":', '"gone":', {"points_finite"}), ("companies", '"i":"', '"i":"z', {"points_are_companies", "details_in_their_shards", "search_covers_companies", "neighbors_published"}), ("search", '"i":"', '"i":"z', {"search_covers_companies"}), ("companies", '"T":["', '"T":["none","', {"tags_published", "scores_parallel"})]:
        back = change(name, old, new)
        spark.catalog.clearCache()
        assert failed() == gates | {"files_match_checksums"}, name
        back()
    assert failed() == set()
    manifest = files.read_document(spark, f"file://{folder}/manifest.json")
    files.write_document(spark, f"file://{folder}/manifest.json", {k: v for k, v in manifest.items() if k != "source_url"})
    assert failed() == {"provenance"}
    files.write_document(spark, f"file://{folder.parent}/index.json", {"current": "none"})
    assert len(failed()) == 10


def test_the_stream_gives_what_the_batch_gives(spark):
    batch = finalize_last_wins(spark, str(SF)).select("company_id", "tag_id", "judgment_id", "decision", "confidence")
    assert rows(streams.stream_last_wins(spark, str(SF))) == rows(batch)


def test_watermarked_duplicates(spark, tmp_path):
    from weftline.streaming.incremental import deduplicated, read_log

    log = table(spark, str(SF), "company_tag_judgments").select("judgment_id", F.col("appended_at").cast("timestamp").alias("at"))
    log.write.parquet(str(tmp_path / "log"))
    q = deduplicated(read_log(spark, str(tmp_path / "log"), log.schema), "judgment_id", "at", "3650 days").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == log.select("judgment_id").distinct().count()
