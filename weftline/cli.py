"""python -m weftline.cli COMMAND: queries, stages and checks from the command line."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from weftline import stages
from weftline.config import load_config
from weftline.operators import ontology, release, search
from weftline.plans import catalog
from weftline.runtime import session
from weftline.sources.models import resolve_model
from weftline.sources.schemas import export_schemas
from weftline.sources.tables import table

COMMANDS = ["doctor", "queries", "query", *stages.STAGES, "migrate-ontology", "validate", "stats", "schemas", "search", "run"]


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="weftline", description=__doc__)
    p.add_argument("command", choices=COMMANDS)
    p.add_argument("--data", help="folder of the source tables")
    p.add_argument("--out", help="warehouse folder")
    p.add_argument("--name", help="query to run, or words to search for")
    p.add_argument("--profile", help="settings profile")
    p.add_argument("--limit", type=int, default=20, help="rows to show")
    p.add_argument("--force", action="store_true")
    a = p.parse_args(argv)
    if a.command == "queries":
        print("\n".join(catalog.QUERIES))
        return 0
    spark = session()
    if a.command == "schemas":
        print(json.dumps({k: json.loads(v) for k, v in export_schemas().items()}, indent=1, sort_keys=True))
        return 0
    r = stages.Run(spark, a.data, a.out, load_config({"profile": a.profile}), stages.default_backend())
    if a.command == "doctor":
        model = resolve_model(r.backend, r.backend.name)
        print(json.dumps({"spark": spark.version, "master": spark.sparkContext.master, "parallelism": spark.sparkContext.defaultParallelism, "model": model, "profile": r.config.profile}))
        return 0
    if a.command == "query":
        catalog.QUERIES[a.name](spark, a.data).show(a.limit, truncate=False)
        return 0
    if a.command == "stats":
        ontology.registry_stats(table(spark, a.data, "tags")).show()
        return 0
    if a.command == "search":
        search.search(stages.search_index(r), a.name, a.limit).select("doc", "score", F.array_join(search.explain_match(), ", ").alias("why")).show(a.limit, truncate=False)
        return 0
    if a.command == "migrate-ontology":
        print(a.command, json.dumps(stages.migrate(r)))
        return 0
    if a.command != "validate":
        for name in stages.STAGES if a.command == "run" else [a.command]:
            if not stages.run(r, name, a.force, lambda stage, counts: print(stage, json.dumps(counts))):
                print(name, "is fresh")
    if a.command in ("validate", "run"):
        gates = release.published_gates(spark, f"{a.out}/public") if a.out else catalog.QUERIES["release_gates"](spark, a.data)
        gates.show(100, truncate=False)
        return int(gates.where(~F.col("passed")).limit(1).count() > 0)
    return 0


if __name__ == "__main__":
    sys.exit(main())
