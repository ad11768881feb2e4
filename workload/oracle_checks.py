"""What each declared check counts, as DuckDB SQL: (check, table, severity, statement that counts failing rows)."""

from __future__ import annotations

STAGING = [
    ("unique_stg_users_user_id", "stg_users", "error",
     "SELECT count(*) FROM (SELECT 1 FROM stg_users WHERE user_id IS NOT NULL GROUP BY user_id HAVING count(*) > 1)"),
    ("not_null_stg_users_user_id", "stg_users", "error", "SELECT count(*) FROM stg_users WHERE user_id IS NULL"),
    ("not_null_stg_users_email", "stg_users", "error", "SELECT count(*) FROM stg_users WHERE email IS NULL"),
    ("unique_stg_members_org_id_user_id", "stg_members", "error",
     "SELECT count(*) FROM (SELECT 1 FROM stg_members GROUP BY org_id, user_id HAVING count(*) > 1)"),
    ("not_null_stg_members_user_id", "stg_members", "error", "SELECT count(*) FROM stg_members WHERE user_id IS NULL"),
    ("not_null_stg_members_org_id", "stg_members", "error", "SELECT count(*) FROM stg_members WHERE org_id IS NULL"),
    ("relationships_stg_members_user_id", "stg_members", "error",
     "SELECT count(*) FROM stg_members WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT user_id FROM stg_users WHERE user_id IS NOT NULL)"),
    ("relationships_stg_members_org_id", "stg_members", "error",
     "SELECT count(*) FROM stg_members WHERE org_id IS NOT NULL AND org_id NOT IN (SELECT org_id FROM stg_organizations WHERE org_id IS NOT NULL)"),
    ("unique_stg_organizations_org_id", "stg_organizations", "error",
     "SELECT count(*) FROM (SELECT 1 FROM stg_organizations WHERE org_id IS NOT NULL GROUP BY org_id HAVING count(*) > 1)"),
    ("not_null_stg_organizations_org_id", "stg_organizations", "error",
     "SELECT count(*) FROM stg_organizations WHERE org_id IS NULL"),
    ("accepted_values_stg_organizations_plan", "stg_organizations", "error",
     "SELECT count(*) FROM stg_organizations WHERE NOT (plan IN ('Enterprise', 'Pro', 'Free', 'enterprise', 'pro', 'free'))"),
    ("unique_stg_projects_project_id", "stg_projects", "error",
     "SELECT count(*) FROM (SELECT 1 FROM stg_projects WHERE project_id IS NOT NULL GROUP BY project_id HAVING count(*) > 1)"),
    ("not_null_stg_projects_project_id", "stg_projects", "error",
     "SELECT count(*) FROM stg_projects WHERE project_id IS NULL"),
    ("not_null_stg_projects_org_id", "stg_projects", "error", "SELECT count(*) FROM stg_projects WHERE org_id IS NULL"),
    ("relationships_stg_projects_org_id", "stg_projects", "error",
     "SELECT count(*) FROM stg_projects WHERE org_id IS NOT NULL AND org_id NOT IN (SELECT org_id FROM stg_organizations WHERE org_id IS NOT NULL)"),
    ("unique_stg_experiments_experiment_id", "stg_experiments", "error",
     "SELECT count(*) FROM (SELECT 1 FROM stg_experiments WHERE experiment_id IS NOT NULL GROUP BY experiment_id HAVING count(*) > 1)"),
    ("not_null_stg_experiments_experiment_id", "stg_experiments", "error",
     "SELECT count(*) FROM stg_experiments WHERE experiment_id IS NULL"),
    ("not_null_stg_experiments_project_id", "stg_experiments", "error",
     "SELECT count(*) FROM stg_experiments WHERE project_id IS NULL"),
    ("relationships_stg_experiments_project_id", "stg_experiments", "error",
     "SELECT count(*) FROM stg_experiments WHERE project_id IS NOT NULL AND project_id NOT IN (SELECT project_id FROM stg_projects WHERE project_id IS NOT NULL)"),
    ("relationships_stg_experiments_user_id", "stg_experiments", "error",
     "SELECT count(*) FROM stg_experiments WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT user_id FROM stg_users WHERE user_id IS NOT NULL)"),
    ("repo_info_json_parses", "stg_experiments", "error",
     "SELECT count(*) FROM stg_experiments WHERE NOT (repo_info_json IS NULL OR repo_commit IS NOT NULL)"),
    ("repo_commit_time_is_placeholder", "stg_experiments", "warn",
     "SELECT count(*) FROM stg_experiments WHERE NOT (repo_commit_time IS NULL OR repo_commit_time <= created_at)"),
    ("unique_stg_datasets_dataset_id", "stg_datasets", "error",
     "SELECT count(*) FROM (SELECT 1 FROM stg_datasets WHERE dataset_id IS NOT NULL GROUP BY dataset_id HAVING count(*) > 1)"),
    ("not_null_stg_datasets_dataset_id", "stg_datasets", "error",
     "SELECT count(*) FROM stg_datasets WHERE dataset_id IS NULL"),
    ("relationships_stg_datasets_project_id", "stg_datasets", "error",
     "SELECT count(*) FROM stg_datasets WHERE project_id IS NOT NULL AND project_id NOT IN (SELECT project_id FROM stg_projects WHERE project_id IS NOT NULL)"),
    ("relationships_stg_datasets_user_id", "stg_datasets", "error",
     "SELECT count(*) FROM stg_datasets WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT user_id FROM stg_users WHERE user_id IS NOT NULL)"),
    ("unique_stg_prompts_prompt_id", "stg_prompts", "error",
     "SELECT count(*) FROM (SELECT 1 FROM stg_prompts WHERE prompt_id IS NOT NULL GROUP BY prompt_id HAVING count(*) > 1)"),
    ("not_null_stg_prompts_prompt_id", "stg_prompts", "error",
     "SELECT count(*) FROM stg_prompts WHERE prompt_id IS NULL"),
    ("relationships_stg_prompts_project_id", "stg_prompts", "error",
     "SELECT count(*) FROM stg_prompts WHERE project_id IS NOT NULL AND project_id NOT IN (SELECT project_id FROM stg_projects WHERE project_id IS NOT NULL)"),
    ("relationships_stg_prompts_user_id", "stg_prompts", "error",
     "SELECT count(*) FROM stg_prompts WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT user_id FROM stg_users WHERE user_id IS NOT NULL)"),
    ("not_null_stg_segment_pages_viewed_at", "stg_segment_pages", "error",
     "SELECT count(*) FROM stg_segment_pages WHERE viewed_at IS NULL"),
    ("relationships_stg_segment_pages_user_id", "stg_segment_pages", "error",
     "SELECT count(*) FROM stg_segment_pages WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT user_id FROM stg_users WHERE user_id IS NOT NULL)"),
    ("not_null_stg_cli_wizard_user_id", "stg_cli_wizard", "error",
     "SELECT count(*) FROM stg_cli_wizard WHERE user_id IS NULL"),
    ("accepted_values_stg_docs_mcp_events_action", "stg_docs_mcp_events", "warn",
     "SELECT count(*) FROM stg_docs_mcp_events WHERE NOT (action IN ('copy_add_mcp_command', 'install_mcp_server'))"),
    ("unique_stg_api_keys_api_key_id", "stg_api_keys", "error",
     "SELECT count(*) FROM (SELECT 1 FROM stg_api_keys WHERE api_key_id IS NOT NULL GROUP BY api_key_id HAVING count(*) > 1)"),
    ("not_null_stg_api_keys_api_key_id", "stg_api_keys", "error",
     "SELECT count(*) FROM stg_api_keys WHERE api_key_id IS NULL"),
    ("unique_stg_trace_volume_org_id_activity_date", "stg_trace_volume", "error",
     "SELECT count(*) FROM (SELECT 1 FROM stg_trace_volume GROUP BY org_id, activity_date HAVING count(*) > 1)"),
    ("between_stg_trace_volume_ingested_gb", "stg_trace_volume", "error",
     "SELECT count(*) FROM stg_trace_volume WHERE ingested_gb < 0 OR ingested_gb > 100000"),
    ("unique_stg_salesforce_accounts_account_id", "stg_salesforce_accounts", "error",
     "SELECT count(*) FROM (SELECT 1 FROM stg_salesforce_accounts WHERE account_id IS NOT NULL GROUP BY account_id HAVING count(*) > 1)"),
    ("not_null_stg_salesforce_accounts_account_id", "stg_salesforce_accounts", "error",
     "SELECT count(*) FROM stg_salesforce_accounts WHERE account_id IS NULL"),
    ("unique_stg_account_org_map_org_id_account_id", "stg_account_org_map", "error",
     "SELECT count(*) FROM (SELECT 1 FROM stg_account_org_map GROUP BY org_id, account_id HAVING count(*) > 1)"),
    ("relationships_stg_account_org_map_account_id", "stg_account_org_map", "error",
     "SELECT count(*) FROM stg_account_org_map WHERE account_id IS NOT NULL AND account_id NOT IN (SELECT account_id FROM stg_salesforce_accounts WHERE account_id IS NOT NULL)"),
    ("relationships_stg_account_org_map_org_id", "stg_account_org_map", "error",
     "SELECT count(*) FROM stg_account_org_map WHERE org_id IS NOT NULL AND org_id NOT IN (SELECT org_id FROM stg_organizations WHERE org_id IS NOT NULL)"),
    ("relationships_stg_account_org_map_mapping_source", "stg_account_org_map", "warn",
     "SELECT count(*) FROM stg_account_org_map WHERE mapping_source IS NOT NULL AND mapping_source NOT IN (SELECT mapping_source FROM rule_org_mapping_sources WHERE mapping_source IS NOT NULL)"),
    ("unique_stg_signal_companies_company_id", "stg_signal_companies", "error",
     "SELECT count(*) FROM (SELECT 1 FROM stg_signal_companies WHERE company_id IS NOT NULL GROUP BY company_id HAVING count(*) > 1)"),
    ("not_null_stg_signal_companies_company_id", "stg_signal_companies", "error",
     "SELECT count(*) FROM stg_signal_companies WHERE company_id IS NULL"),
    ("unique_stg_news_events_news_id", "stg_news_events", "error",
     "SELECT count(*) FROM (SELECT 1 FROM stg_news_events WHERE news_id IS NOT NULL GROUP BY news_id HAVING count(*) > 1)"),
    ("not_null_stg_news_events_news_id", "stg_news_events", "error",
     "SELECT count(*) FROM stg_news_events WHERE news_id IS NULL"),
    ("not_null_stg_news_events_company_id", "stg_news_events", "error",
     "SELECT count(*) FROM stg_news_events WHERE company_id IS NULL"),
    ("relationships_stg_news_events_company_id", "stg_news_events", "error",
     "SELECT count(*) FROM stg_news_events WHERE company_id IS NOT NULL AND company_id NOT IN (SELECT company_id FROM stg_signal_companies WHERE company_id IS NOT NULL)"),
    ("between_stg_news_events_vendor_confidence", "stg_news_events", "error",
     "SELECT count(*) FROM stg_news_events WHERE vendor_confidence < 0 OR vendor_confidence > 1"),
    ("unique_stg_products_product_id", "stg_products", "error",
     "SELECT count(*) FROM (SELECT 1 FROM stg_products WHERE product_id IS NOT NULL GROUP BY product_id HAVING count(*) > 1)"),
    ("not_null_stg_products_product_id", "stg_products", "error",
     "SELECT count(*) FROM stg_products WHERE product_id IS NULL"),
    ("relationships_stg_products_company_id", "stg_products", "error",
     "SELECT count(*) FROM stg_products WHERE company_id IS NOT NULL AND company_id NOT IN (SELECT company_id FROM stg_signal_companies WHERE company_id IS NOT NULL)"),
    ("unique_stg_tech_detections_detection_id", "stg_tech_detections", "error",
     "SELECT count(*) FROM (SELECT 1 FROM stg_tech_detections WHERE detection_id IS NOT NULL GROUP BY detection_id HAVING count(*) > 1)"),
    ("not_null_stg_tech_detections_detection_id", "stg_tech_detections", "error",
     "SELECT count(*) FROM stg_tech_detections WHERE detection_id IS NULL"),
    ("relationships_stg_tech_detections_company_id", "stg_tech_detections", "error",
     "SELECT count(*) FROM stg_tech_detections WHERE company_id IS NOT NULL AND company_id NOT IN (SELECT company_id FROM stg_signal_companies WHERE company_id IS NOT NULL)"),
    ("between_stg_tech_detections_vendor_score", "stg_tech_detections", "error",
     "SELECT count(*) FROM stg_tech_detections WHERE vendor_score < 0 OR vendor_score > 1"),
    ("unique_rule_org_mapping_sources_mapping_source", "rule_org_mapping_sources", "error",
     "SELECT count(*) FROM (SELECT 1 FROM rule_org_mapping_sources WHERE mapping_source IS NOT NULL GROUP BY mapping_source HAVING count(*) > 1)"),
    ("not_null_rule_org_mapping_sources_mapping_source", "rule_org_mapping_sources", "error",
     "SELECT count(*) FROM rule_org_mapping_sources WHERE mapping_source IS NULL"),
    ("between_rule_org_mapping_sources_confidence_score", "rule_org_mapping_sources", "error",
     "SELECT count(*) FROM rule_org_mapping_sources WHERE confidence_score < 0 OR confidence_score > 1"),
    ("unique_rule_external_match_rules_match_method", "rule_external_match_rules", "error",
     "SELECT count(*) FROM (SELECT 1 FROM rule_external_match_rules WHERE match_method IS NOT NULL GROUP BY match_method HAVING count(*) > 1)"),
    ("not_null_rule_external_match_rules_match_method", "rule_external_match_rules", "error",
     "SELECT count(*) FROM rule_external_match_rules WHERE match_method IS NULL"),
    ("unique_rule_external_match_rules_precedence", "rule_external_match_rules", "error",
     "SELECT count(*) FROM (SELECT 1 FROM rule_external_match_rules WHERE precedence IS NOT NULL GROUP BY precedence HAVING count(*) > 1)"),
    ("not_null_rule_external_match_rules_precedence", "rule_external_match_rules", "error",
     "SELECT count(*) FROM rule_external_match_rules WHERE precedence IS NULL"),
    ("unique_rule_surface_signals_signal_code", "rule_surface_signals", "error",
     "SELECT count(*) FROM (SELECT 1 FROM rule_surface_signals WHERE signal_code IS NOT NULL GROUP BY signal_code HAVING count(*) > 1)"),
    ("not_null_rule_surface_signals_signal_code", "rule_surface_signals", "error",
     "SELECT count(*) FROM rule_surface_signals WHERE signal_code IS NULL"),
    ("accepted_values_rule_surface_signals_surface", "rule_surface_signals", "error",
     "SELECT count(*) FROM rule_surface_signals WHERE NOT (surface IN ('ui', 'sdk', 'cli', 'mcp', 'unknown'))"),
    ("accepted_values_rule_surface_signals_evidence_kind", "rule_surface_signals", "error",
     "SELECT count(*) FROM rule_surface_signals WHERE NOT (evidence_kind IN ('usage', 'intent'))"),
    ("accepted_values_rule_surface_signals_attribution", "rule_surface_signals", "error",
     "SELECT count(*) FROM rule_surface_signals WHERE NOT (attribution IN ('deterministic', 'heuristic', 'none'))"),
    ("between_rule_surface_signals_confidence_score", "rule_surface_signals", "error",
     "SELECT count(*) FROM rule_surface_signals WHERE confidence_score < 0 OR confidence_score > 1"),
]

RESOLVED = [
    ("unique_identity_user_id", "identity", "error",
     "SELECT count(*) FROM (SELECT 1 FROM identity WHERE user_id IS NOT NULL GROUP BY user_id HAVING count(*) > 1)"),
    ("not_null_identity_user_id", "identity", "error", "SELECT count(*) FROM identity WHERE user_id IS NULL"),
    ("not_null_identity_person_id", "identity", "error", "SELECT count(*) FROM identity WHERE person_id IS NULL"),
    ("logins_sharing_an_email", "identity", "warn", "SELECT count(*) FROM identity WHERE NOT (NOT is_duplicate_login)"),
    ("row_count_identity_matches_stg_users", "identity", "error",
     "SELECT CASE WHEN (SELECT count(*) FROM identity) <> (SELECT count(*) FROM stg_users) THEN 1 ELSE 0 END"),
    ("row_count_org_accounts_matches_stg_organizations", "org_accounts", "error",
     "SELECT CASE WHEN (SELECT count(*) FROM org_accounts) <> (SELECT count(*) FROM stg_organizations) THEN 1 ELSE 0 END"),
    ("mapped_org_has_source_and_confidence", "org_accounts", "error",
     "SELECT count(*) FROM org_accounts WHERE NOT (account_id IS NULL OR (mapping_source IS NOT NULL AND mapping_confidence IS NOT NULL))"),
    ("ambiguous_org_has_no_account", "org_accounts", "error",
     "SELECT count(*) FROM org_accounts WHERE NOT (NOT is_ambiguous OR account_id IS NULL)"),
    ("unique_org_accounts_org_id", "org_accounts", "error",
     "SELECT count(*) FROM (SELECT 1 FROM org_accounts WHERE org_id IS NOT NULL GROUP BY org_id HAVING count(*) > 1)"),
    ("not_null_org_accounts_org_id", "org_accounts", "error", "SELECT count(*) FROM org_accounts WHERE org_id IS NULL"),
    ("accepted_values_org_accounts_resolution_status", "org_accounts", "error",
     "SELECT count(*) FROM org_accounts WHERE NOT (resolution_status IN ('resolved', 'resolved_low_confidence', 'ambiguous', 'unmapped', 'broken_link'))"),
    ("org_mapped_by_fallback_only", "org_accounts", "warn",
     "SELECT count(*) FROM org_accounts WHERE NOT (resolution_status <> 'resolved_low_confidence')"),
    ("between_org_accounts_mapping_confidence", "org_accounts", "error",
     "SELECT count(*) FROM org_accounts WHERE mapping_confidence < 0 OR mapping_confidence > 1"),
    ("unique_memberships_person_id_org_id", "memberships", "error",
     "SELECT count(*) FROM (SELECT 1 FROM memberships GROUP BY person_id, org_id HAVING count(*) > 1)"),
    ("unique_api_keys_api_key_id", "api_keys", "error",
     "SELECT count(*) FROM (SELECT 1 FROM api_keys WHERE api_key_id IS NOT NULL GROUP BY api_key_id HAVING count(*) > 1)"),
    ("not_null_api_keys_api_key_id", "api_keys", "error", "SELECT count(*) FROM api_keys WHERE api_key_id IS NULL"),
    ("not_null_api_keys_person_id", "api_keys", "error", "SELECT count(*) FROM api_keys WHERE person_id IS NULL"),
    ("ambiguous_person_has_no_account", "people", "error",
     "SELECT count(*) FROM people WHERE NOT (NOT is_ambiguous OR account_id IS NULL)"),
    ("unique_people_person_id", "people", "error",
     "SELECT count(*) FROM (SELECT 1 FROM people WHERE person_id IS NOT NULL GROUP BY person_id HAVING count(*) > 1)"),
    ("not_null_people_person_id", "people", "error", "SELECT count(*) FROM people WHERE person_id IS NULL"),
    ("accepted_values_people_resolution_status", "people", "error",
     "SELECT count(*) FROM people WHERE NOT (resolution_status IN ('resolved', 'ambiguous_multi_account', 'partially_mapped', 'org_not_mapped', 'no_membership'))"),
    ("every_activity_has_a_surface", "activity", "error",
     "SELECT count(*) FROM activity WHERE NOT (surface IS NOT NULL)"),
    ("projects_imply_orgs", "activity", "error",
     "SELECT count(*) FROM activity WHERE NOT (project_id IS NULL OR org_id IS NOT NULL)"),
    ("unique_activity_activity_id", "activity", "error",
     "SELECT count(*) FROM (SELECT 1 FROM activity WHERE activity_id IS NOT NULL GROUP BY activity_id HAVING count(*) > 1)"),
    ("not_null_activity_activity_id", "activity", "error", "SELECT count(*) FROM activity WHERE activity_id IS NULL"),
    ("not_null_activity_person_id", "activity", "error", "SELECT count(*) FROM activity WHERE person_id IS NULL"),
    ("accepted_values_activity_surface", "activity", "error",
     "SELECT count(*) FROM activity WHERE NOT (surface IN ('ui', 'sdk', 'cli', 'mcp', 'unknown'))"),
    ("accepted_values_activity_evidence_kind", "activity", "error",
     "SELECT count(*) FROM activity WHERE NOT (evidence_kind IN ('usage', 'intent'))"),
    ("accepted_values_activity_actor_type", "activity", "error",
     "SELECT count(*) FROM activity WHERE NOT (actor_type IN ('human', 'automation', 'unknown'))"),
    ("between_activity_confidence_score", "activity", "error",
     "SELECT count(*) FROM activity WHERE confidence_score < 0 OR confidence_score > 1"),
    ("unique_org_trend_org_id", "org_trend", "error",
     "SELECT count(*) FROM (SELECT 1 FROM org_trend WHERE org_id IS NOT NULL GROUP BY org_id HAVING count(*) > 1)"),
    ("not_null_org_trend_org_id", "org_trend", "error", "SELECT count(*) FROM org_trend WHERE org_id IS NULL"),
    ("unique_account_trend_account_id", "account_trend", "error",
     "SELECT count(*) FROM (SELECT 1 FROM account_trend WHERE account_id IS NOT NULL GROUP BY account_id HAVING count(*) > 1)"),
    ("not_null_account_trend_account_id", "account_trend", "error",
     "SELECT count(*) FROM account_trend WHERE account_id IS NULL"),
    ("between_account_trend_trace_growth_7d", "account_trend", "error",
     "SELECT count(*) FROM account_trend WHERE trace_growth_7d < -1 OR trace_growth_7d > 1000"),
    ("unique_match_keys_entity_type_entity_id", "match_keys", "error",
     "SELECT count(*) FROM (SELECT 1 FROM match_keys GROUP BY entity_type, entity_id HAVING count(*) > 1)"),
    ("every_entity_keeps_its_identity", "match_keys", "error",
     "SELECT count(*) FROM match_keys WHERE NOT (entity_id IS NOT NULL AND entity_name IS NOT NULL)"),
    ("accepted_values_match_keys_entity_type", "match_keys", "error",
     "SELECT count(*) FROM match_keys WHERE NOT (entity_type IN ('account', 'company'))"),
    ("unique_candidates_company_id_match_method", "candidates", "error",
     "SELECT count(*) FROM (SELECT 1 FROM (SELECT DISTINCT company_id, match_method, matched_value FROM candidates) GROUP BY company_id, match_method HAVING count(*) > 1)"),
    ("row_count_companies_matches_stg_signal_companies", "companies", "error",
     "SELECT CASE WHEN (SELECT count(*) FROM companies) <> (SELECT count(*) FROM stg_signal_companies) THEN 1 ELSE 0 END"),
    ("resolved_has_account_method_and_confidence", "companies", "error",
     "SELECT count(*) FROM companies WHERE NOT (resolution_status <> 'resolved' OR (account_id IS NOT NULL AND match_method IS NOT NULL AND match_confidence IS NOT NULL))"),
    ("conflicts_never_resolved", "companies", "error",
     "SELECT count(*) FROM companies WHERE NOT (NOT is_conflict OR account_id IS NULL)"),
    ("name_never_decides", "companies", "error",
     "SELECT count(*) FROM companies WHERE NOT (match_method IS NULL OR match_method <> 'company_name')"),
    ("unique_companies_company_id", "companies", "error",
     "SELECT count(*) FROM (SELECT 1 FROM companies WHERE company_id IS NOT NULL GROUP BY company_id HAVING count(*) > 1)"),
    ("not_null_companies_company_id", "companies", "error", "SELECT count(*) FROM companies WHERE company_id IS NULL"),
    ("accepted_values_companies_resolution_status", "companies", "error",
     "SELECT count(*) FROM companies WHERE NOT (resolution_status IN ('resolved', 'conflict', 'ambiguous', 'unmatched', 'no_identifiers'))"),
    ("between_companies_match_confidence", "companies", "error",
     "SELECT count(*) FROM companies WHERE match_confidence < 0 OR match_confidence > 1"),
    ("relationships_companies_account_id", "companies", "error",
     "SELECT count(*) FROM companies WHERE account_id IS NOT NULL AND account_id NOT IN (SELECT account_id FROM stg_salesforce_accounts WHERE account_id IS NOT NULL)"),
    ("unique_signals_signal_id", "signals", "error",
     "SELECT count(*) FROM (SELECT 1 FROM signals WHERE signal_id IS NOT NULL GROUP BY signal_id HAVING count(*) > 1)"),
    ("not_null_signals_signal_id", "signals", "error", "SELECT count(*) FROM signals WHERE signal_id IS NULL"),
    ("headline_names_a_different_company", "signals", "warn",
     "SELECT count(*) FROM signals WHERE NOT (NOT is_entity_mismatch)"),
]

MARTS = [
    ("unique_members_person_id", "members", "error",
     "SELECT count(*) FROM (SELECT 1 FROM members WHERE person_id IS NOT NULL GROUP BY person_id HAVING count(*) > 1)"),
    ("not_null_members_person_id", "members", "error", "SELECT count(*) FROM members WHERE person_id IS NULL"),
    ("accepted_values_members_member_type", "members", "error",
     "SELECT count(*) FROM members WHERE NOT (member_type IN ('human', 'automation_identity', 'undetermined'))"),
    ("automation_identity_never_shown_as_human", "members", "error",
     "SELECT count(*) FROM members WHERE NOT (member_type <> 'automation_identity' OR (coalesce(ui_evidence, 'no_evidence') IN ('no_evidence', 'intent_only') AND coalesce(sdk_evidence, 'no_evidence') IN ('no_evidence', 'intent_only')))"),
    ("unique_member_surfaces_person_id_surface", "member_surfaces", "error",
     "SELECT count(*) FROM (SELECT 1 FROM member_surfaces GROUP BY person_id, surface HAVING count(*) > 1)"),
    ("cli_and_mcp_never_usage", "member_surfaces", "error",
     "SELECT count(*) FROM member_surfaces WHERE NOT (surface NOT IN ('cli', 'mcp') OR evidence_status IN ('intent_only', 'no_evidence'))"),
    ("human_evidence_never_exceeds_total", "member_surfaces", "error",
     "SELECT count(*) FROM member_surfaces WHERE NOT (human_evidence_status = evidence_status OR human_evidence_status = 'no_evidence' OR (human_evidence_status = 'intent_only' AND evidence_status <> 'no_evidence'))"),
    ("accepted_values_member_surfaces_evidence_status", "member_surfaces", "error",
     "SELECT count(*) FROM member_surfaces WHERE NOT (evidence_status IN ('usage_proven', 'usage_likely', 'intent_only', 'origin_unknown', 'no_evidence'))"),
    ("accepted_values_member_surfaces_human_evidence_status", "member_surfaces", "error",
     "SELECT count(*) FROM member_surfaces WHERE NOT (human_evidence_status IN ('usage_proven', 'usage_likely', 'intent_only', 'origin_unknown', 'no_evidence'))"),
    ("unique_adoption_account_id_surface", "adoption", "error",
     "SELECT count(*) FROM (SELECT 1 FROM adoption GROUP BY account_id, surface HAVING count(*) > 1)"),
    ("no_percentage_when_unmeasurable", "adoption", "error",
     "SELECT count(*) FROM adoption WHERE NOT (usage_is_measurable OR pct_members_usage_proven IS NULL)"),
    ("member_counts_within_known_members", "adoption", "error",
     "SELECT count(*) FROM adoption WHERE NOT (members_usage_proven + members_usage_likely + members_intent_only <= known_members)"),
    ("org_proof_never_member_usage", "adoption", "error",
     "SELECT count(*) FROM adoption WHERE NOT (evidence_level <> 'org' OR coalesce(pct_members_usage_proven, 0) = 0)"),
    ("status_needs_evidence", "adoption", "error",
     "SELECT count(*) FROM adoption WHERE NOT (evidence_level <> 'none' OR account_evidence_status IN ('no_evidence', 'not_measurable'))"),
    ("accepted_values_adoption_account_evidence_status", "adoption", "error",
     "SELECT count(*) FROM adoption WHERE NOT (account_evidence_status IN ('usage_proven', 'usage_likely', 'intent_only', 'not_measurable', 'no_evidence'))"),
    ("accepted_values_adoption_evidence_level", "adoption", "error",
     "SELECT count(*) FROM adoption WHERE NOT (evidence_level IN ('member', 'org', 'none'))"),
    ("row_count_signal_companies_matches_stg_signal_companies", "signal_companies", "error",
     "SELECT CASE WHEN (SELECT count(*) FROM signal_companies) <> (SELECT count(*) FROM stg_signal_companies) THEN 1 ELSE 0 END"),
    ("unique_signal_companies_company_id", "signal_companies", "error",
     "SELECT count(*) FROM (SELECT 1 FROM signal_companies WHERE company_id IS NOT NULL GROUP BY company_id HAVING count(*) > 1)"),
    ("not_null_signal_companies_company_id", "signal_companies", "error",
     "SELECT count(*) FROM signal_companies WHERE company_id IS NULL"),
    ("accepted_values_signal_companies_next_action", "signal_companies", "error",
     "SELECT count(*) FROM signal_companies WHERE NOT (next_action IN ('attach_to_account', 'confirm_match', 'steward_review', 'net_new_prospect', 'enrich_identifiers'))"),
    ("unique_feed_signal_id", "feed", "error",
     "SELECT count(*) FROM (SELECT 1 FROM feed WHERE signal_id IS NOT NULL GROUP BY signal_id HAVING count(*) > 1)"),
    ("not_null_feed_signal_id", "feed", "error", "SELECT count(*) FROM feed WHERE signal_id IS NULL"),
    ("not_null_feed_account_id", "feed", "error", "SELECT count(*) FROM feed WHERE account_id IS NULL"),
    ("relationships_feed_account_id", "feed", "error",
     "SELECT count(*) FROM feed WHERE account_id IS NOT NULL AND account_id NOT IN (SELECT account_id FROM stg_salesforce_accounts WHERE account_id IS NOT NULL)"),
    ("accepted_values_feed_signal_source", "feed", "error",
     "SELECT count(*) FROM feed WHERE NOT (signal_source IN ('external', 'product'))"),
    ("between_feed_signal_confidence", "feed", "error",
     "SELECT count(*) FROM feed WHERE signal_confidence < 0 OR signal_confidence > 1"),
    ("flagged_signals_never_actionable", "feed", "error",
     "SELECT count(*) FROM feed WHERE NOT (NOT (needs_review AND is_actionable))"),
    ("row_count_account_360_matches_stg_salesforce_accounts", "account_360", "error",
     "SELECT CASE WHEN (SELECT count(*) FROM account_360) <> (SELECT count(*) FROM stg_salesforce_accounts) THEN 1 ELSE 0 END"),
    ("unique_account_360_account_id", "account_360", "error",
     "SELECT count(*) FROM (SELECT 1 FROM account_360 WHERE account_id IS NOT NULL GROUP BY account_id HAVING count(*) > 1)"),
    ("not_null_account_360_account_id", "account_360", "error",
     "SELECT count(*) FROM account_360 WHERE account_id IS NULL"),
    ("unique_account_360_priority_rank", "account_360", "error",
     "SELECT count(*) FROM (SELECT 1 FROM account_360 WHERE priority_rank IS NOT NULL GROUP BY priority_rank HAVING count(*) > 1)"),
    ("not_null_account_360_priority_rank", "account_360", "error",
     "SELECT count(*) FROM account_360 WHERE priority_rank IS NULL"),
    ("unique_prospects_prospect_id", "prospects", "error",
     "SELECT count(*) FROM (SELECT 1 FROM prospects WHERE prospect_id IS NOT NULL GROUP BY prospect_id HAVING count(*) > 1)"),
    ("not_null_prospects_prospect_id", "prospects", "error",
     "SELECT count(*) FROM prospects WHERE prospect_id IS NULL"),
    ("accepted_values_prospects_prospect_source", "prospects", "error",
     "SELECT count(*) FROM prospects WHERE NOT (prospect_source IN ('external_signal', 'product_signup'))"),
    ("unique_quality_metric_order", "quality", "error",
     "SELECT count(*) FROM (SELECT 1 FROM quality WHERE metric_order IS NOT NULL GROUP BY metric_order HAVING count(*) > 1)"),
    ("not_null_quality_metric_order", "quality", "error", "SELECT count(*) FROM quality WHERE metric_order IS NULL"),
    ("between_quality_rate", "quality", "error", "SELECT count(*) FROM quality WHERE rate < 0 OR rate > 1"),
]
