"""The table contracts: closed schemas as StructTypes, and their JSON export."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

_S, _L, _T, _D = "STRING", "ARRAY<STRING>", "TIMESTAMP_NTZ", "DOUBLE"


def _ddl(**columns: str) -> str:
    return ", ".join(f"{k} {v}" for k, v in columns.items())


_DDL = {
    "companies_raw": _ddl(company_id=_S, source=_S, source_url=_S, retrieved_at=_T, source_last_updated=_S, payload=_S, content_hash=_S),
    "source_taxonomy_terms": _ddl(term_id=_S, kind=_S, slug=_S, name=_S, parent_term_id=_S, company_count="INT", source_path=_S, retrieved_at=_T),
    "web_sources": _ddl(company_id=_S, url=_S, final_url=_S, fetched_at=_T, status="INT", content_type=_S, content_hash=_S, byte_size="INT", extraction_version=_S, ok="BOOLEAN", error=_S, robots_allowed="BOOLEAN"),
    "source_documents": _ddl(document_id=_S, company_id=_S, kind=_S, text=_S, char_count="INT", source_url=_S, content_hash=_S, extraction_version=_S, created_at=_T),
    "companies_normalized": _ddl(
        company_id=_S, yc_id="BIGINT", slug=_S, name=_S, former_names=_L, one_liner=_S, long_description=_S, website=_S, url=_S, logo_url=_S, batch=_S, batch_slug=_S, batch_season=_S, batch_year="INT", status=_S, stage=_S,
        team_size="INT", is_hiring="BOOLEAN", nonprofit="BOOLEAN", top_company="BOOLEAN", industry=_S, subindustry=_S, industries=_L, source_tags=_L, regions=_L, source_taxonomy_term_ids=_L, all_locations=_S, launched_at=_T,
        metadata_document=_S, metadata_template_version=_S, normalize_version=_S, content_hash=_S, updated_at=_T,
    ),
    "tag_candidates": _ddl(candidate_id=_S, proposed_name=_S, normalized_name=_S, facet=_S, definition=_S, positive_examples=_L, negative_examples=_L, support_company_ids=_L, discovery_run_id=_S, model=_S, prompt_version=_S, created_at=_T, resolution=_S, resolved_tag_id=_S),
    "tags": _ddl(
        tag_id=_S, canonical_name=_S, definition=_S, facet=_S, aliases=_L, normalized_aliases=_L, parent_tag_ids=_L, related_tag_ids=_L, positive_examples=_L, negative_examples=_L, source_company_ids=_L, state=_S, merged_into=_S,
        deprecation_reason=_S, support_count="INT", proposer=_S, ontology_version=_S, created_at=_T, updated_at=_T,
    ),
    "tag_aliases": _ddl(alias_id=_S, tag_id=_S, alias=_S, normalized_alias=_S, origin=_S, created_at=_T),
    "merge_proposals": _ddl(proposal_id=_S, source_tag_id=_S, target_tag_id=_S, similarity=_D, verdict=_S, adjudication=_S, rationale=_S, model=_S, created_at=_T, applied="BOOLEAN"),
    "source_taxonomy_tag_mappings": _ddl(mapping_id=_S, term_id=_S, tag_id=_S, relation=_S, similarity=_D, method=_S, reviewed="BOOLEAN", created_at=_T),
    "company_tag_judgments": _ddl(
        judgment_id=_S, company_id=_S, tag_id=_S, decision=_S, confidence=_D, rationale=_S, evidence="ARRAY<STRUCT<document_id: STRING, quote: STRING>>", notes=_S, shortlist_reason=_S, retrieval_score=_D, model=_S,
        prompt_version=_S, ontology_version=_S, pipeline_version=_S, run_id=_S, created_at=_T, appended_at=_T,
    ),
    "company_tag_features": _ddl(company_id=_S, tag_id=_S, present="INT", raw_confidence=_D, calibrated_confidence=_D, information_weight=_D, feature_value=_D, judgment_id=_S, ontology_version=_S, pipeline_version=_S),
    "company_embeddings": _ddl(company_id=_S, kind=_S, dim="INT", space_version=_S, model=_S, digest=_S, template_version=_S, document_hash=_S, vector="ARRAY<FLOAT>", created_at=_T),
    "company_neighbors": _ddl(company_id=_S, neighbor_company_id=_S, space=_S, rank="INT", similarity=_D, space_version=_S),
    "umap_points": _ddl(company_id=_S, x=_D, y=_D, cluster_id="INT", projection_version=_S, space_version=_S),
    "clusters": _ddl(cluster_id="INT", label=_S, label_source=_S, size="INT", top_tag_ids=_L, top_source_terms=_L, centroid_x=_D, centroid_y=_D, projection_version=_S),
    "pipeline_runs": _ddl(run_id=_S, stage=_S, started_at=_T, finished_at=_T, status=_S, profile=_S, pipeline_version=_S, config_fingerprint=_S, models="MAP<STRING, STRING>", prompt_hashes="MAP<STRING, STRING>", counts="MAP<STRING, INT>", error=_S),
    "release_manifest": _ddl(dataset_version=_S, created_at=_T, pipeline_version=_S, models="MAP<STRING, STRING>", prompt_hashes="MAP<STRING, STRING>", checksums="MAP<STRING, STRING>", counts="MAP<STRING, INT>", limitations=_L, licenses="ARRAY<MAP<STRING, STRING>>", attribution=_S),
}
TABLES = tuple(_DDL)


@cache
def schema_of(table: str) -> StructType:
    """The contract of a table (parsing it needs a session)."""
    return StructType.fromDDL(_DDL[table])


#: What the enumerated columns may hold.
ENUMS = {
    ("company_tag_judgments", "decision"): ("yes", "no", "uncertain"), ("tags", "state"): ("candidate", "active", "merged", "deprecated"), ("merge_proposals", "verdict"): ("auto_merge", "review", "distinct"),
    ("source_taxonomy_tag_mappings", "relation"): ("equivalent", "narrower", "broader", "overlaps", "related"), ("company_embeddings", "kind"): ("description", "metadata", "tags", "combined"),
}


def unexpected_columns(df: DataFrame, table: str) -> list[str]:
    """Columns that the contract of a table doesn't have (an error for closed schemas)."""
    return [c for c in df.columns if c not in schema_of(table).names]


def export_schemas() -> dict[str, str]:
    return {k: schema_of(k).json() for k in TABLES}
