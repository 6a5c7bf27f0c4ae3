"""All core queries and their SQL."""

from __future__ import annotations

from weftline.plans import directory, integrity, judging, ontology, publishing, streams, vectors

MODULES = (judging, vectors, directory, ontology, streams, integrity, publishing)

QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
ORACLES = {k: v for m in MODULES for k, v in m.ORACLES.items()}
