"""Rule tables: precedence, confidence and kind of evidence are data, not code.

``load_rules`` gives the built-in rows, or the rows of a CSV file with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# How a product org is linked to a CRM account.
ORG_LINK_SOURCES = {
    "schema": "mapping_source string, confidence_score double, precedence int, rationale string",
    "rows": [
        ("contract", 0.95, 1, "the contract names the org"),
        ("billing_parent", 0.85, 2, "the org is billed under the account; may be a subsidiary"),
        ("org_c_fallback", 0.50, 3, "fallback link nobody has verified"),
    ],
}

# Keys that link an external company to a CRM account.
EXTERNAL_MATCH_RULES = {
    "schema": "match_method string, precedence int, base_confidence double, can_resolve boolean, rationale string",
    "rows": [
        ("linkedin_slug", 1, 0.90, True, "one page per legal entity"),
        ("website_domain", 2, 0.85, True, "own website; shared by parent and subsidiary"),
        ("linkedin_domain", 3, 0.75, True, "website as reported on the company page"),
        ("company_name", 99, 0.00, False, "a hint for review, never a decision"),
    ],
}

# What each product signal is evidence of.
SURFACE_SIGNALS = {
    "schema": "signal_code string, surface string, evidence_kind string, attribution string, "
              "confidence_score double, source_columns string, what_it_proves string, what_it_cannot_prove string",
    "rows": [
        ("ui_page_view", "ui", "usage", "deterministic", 0.95,
         "segment_pages.user_id, path", "a signed-in person opened a page", "the org; any creation"),
        ("code_repo_info", "sdk", "usage", "deterministic", 0.90,
         "experiments.repo_info", "code in a repository logged the object", "SDK or a CLI around it"),
        ("code_ci_run", "sdk", "usage", "deterministic", 0.90,
         "experiments.metadata, experiments.repo_info, datasets.metadata", "a CI job made the object",
         "the person behind the job"),
        ("code_runtime_source", "sdk", "usage", "heuristic", 0.60,
         "experiments.metadata.source", "a server process tagged itself", "that the tag is standard"),
        ("object_origin_unknown", "unknown", "usage", "none", 0.00,
         "objects without repository or tag", "something was made in the project", "by which surface"),
        ("cli_setup_wizard", "cli", "intent", "heuristic", 0.30,
         "cli_wizard.user_id", "the setup page was opened in a browser", "that the CLI ran"),
        ("cli_key_name_hint", "cli", "intent", "heuristic", 0.20,
         "api_keys.name", "a key is named after the CLI", "anything; names are free text"),
        ("mcp_docs_click", "mcp", "intent", "heuristic", 0.30,
         "docs_mcp_events.action", "the install command was copied or clicked", "that a client connected"),
        ("org_trace_ingestion", "sdk", "usage", "deterministic", 0.85,
         "trace_volume.ingested_gb", "the org sends traces from code", "the member, key or surface"),
    ],
}

RULES = {
    "org_mapping_sources": ORG_LINK_SOURCES,
    "external_match_rules": EXTERNAL_MATCH_RULES,
    "surface_signals": SURFACE_SIGNALS,
}


def _inline(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A literal table, which Spark plans as local data of known size."""
    def sql(v: object) -> str:
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v).lower()

    fields = [f.split() for f in schema.split(", ")]
    values = ", ".join("(" + ", ".join(sql(v) for v in row) + ")" for row in rows)
    casts = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in fields)
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS r({', '.join(n for n, _ in fields)})")


def load_rules(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    spec = RULES[name]
    if path is None:
        return _inline(spark, spec["schema"], spec["rows"])
    return spark.read.schema(spec["schema"]).option("header", True).option("escape", '"').csv(path)
