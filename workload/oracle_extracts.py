"""The review extracts as DuckDB SQL, columns written out. A dash stands for null."""

from __future__ import annotations

EXTRACTS = {
    "org": """
        SELECT org_id, plan, coalesce(CAST(account_id AS VARCHAR), '—') AS account_id, coalesce(CAST(mapping_source
        AS VARCHAR), '—') AS mapping_source, coalesce(CAST(mapping_confidence AS VARCHAR), '—') AS
        mapping_confidence, resolution_status FROM org_accounts""",
    "people": """
        SELECT person_id, email, org_count, coalesce(CAST(account_id AS VARCHAR), '—') AS account_id,
        coalesce(CAST(account_confidence AS VARCHAR), '—') AS account_confidence, resolution_status, login_count
        FROM people""",
    "companies": """
        SELECT company_id, company_name, resolution_status, coalesce(CAST(account_id AS VARCHAR), '—') AS
        account_id, coalesce(CAST(match_method AS VARCHAR), '—') AS match_method, match_confidence, needs_review,
        next_action, keys_matched, keys_agreeing, unique_keys_agreeing, coalesce(CAST(match_evidence AS VARCHAR),
        '—') AS match_evidence, name_match_account_id, name_key FROM (SELECT c.*, k.name_key FROM companies c JOIN
        match_keys k ON k.entity_type = 'company' AND k.entity_id = c.company_id)""",
    "members": """
        SELECT person_id, email, coalesce(CAST(account_id AS VARCHAR), '—') AS account_id, member_type, ui_evidence,
        sdk_evidence, coalesce(CAST(sdk_evidence_any_actor AS VARCHAR), '—') AS sdk_evidence_any_actor,
        cli_evidence, mcp_evidence, human_usage_events, automated_usage_events, api_key_count FROM members""",
    "adoption": """
        SELECT account_id, surface, surface_order, usage_is_measurable, known_members, members_usage_proven,
        members_intent_only, members_automation_only, account_evidence_status, evidence_level,
        pct_members_usage_proven, honest_summary FROM adoption""",
    "account_360": """
        SELECT priority_rank, account_id, account_name, coalesce(CAST(best_plan AS VARCHAR), '—') AS best_plan,
        known_members, active_members_in_lookback, coalesce(CAST(ui_adoption AS VARCHAR), '—') AS ui_adoption,
        coalesce(CAST(sdk_adoption AS VARCHAR), '—') AS sdk_adoption, coalesce(CAST(sdk_evidence_level AS VARCHAR),
        '—') AS sdk_evidence_level, coalesce(CAST(cli_adoption AS VARCHAR), '—') AS cli_adoption,
        coalesce(CAST(mcp_adoption AS VARCHAR), '—') AS mcp_adoption, trace_gb_last_7d, trace_growth_7d,
        actionable_signals, signals_needing_review, external_records_pending_review,
        external_records_awaiting_confirmation, top_action_reason, coalesce(CAST(crm_identifier_gaps AS VARCHAR),
        '—') AS crm_identifier_gaps FROM account_360""",
    "signals": """
        SELECT signal_id, account_id, signal_source, signal_type, occurred_at, headline, signal_confidence,
        attribution, attribution_confidence, is_actionable, needs_review FROM feed""",
    "quality": """
        SELECT metric_order, area, metric, numerator, denominator, rate FROM quality""",
    "prospects": """
        SELECT prospect_id, prospect_source, prospect_name, coalesce(CAST(domain AS VARCHAR), '—') AS domain,
        coalesce(CAST(product_plan AS VARCHAR), '—') AS product_plan, product_members, signals_in_lookback,
        why_it_matters, coalesce(CAST(latest_headline AS VARCHAR), '—') AS latest_headline FROM prospects""",
    "traces": """
        SELECT org_id, days_with_data, gb_last_7d, gb_baseline_day, gb_last_day, growth_7d FROM org_trend""",
    "keys": """
        SELECT entity_type, entity_id, entity_name, coalesce(CAST(domain_key AS VARCHAR), '—') AS domain_key,
        coalesce(CAST(linkedin_slug AS VARCHAR), '—') AS linkedin_slug, coalesce(CAST(name_key AS VARCHAR), '—') AS
        name_key, coalesce(CAST(name_first_token AS VARCHAR), '—') AS name_first_token, is_domain_shared FROM
        match_keys""",
}
