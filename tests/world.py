"""A small delivered world of our own, as CSV rows. As-of date 2026-03-31, 30 days of lookback."""

from __future__ import annotations

import csv

from accountlens.sources.staging import DELIVERED

REPO = '{"commit":"c1","branch":"main","dirty":%s,"author_name":"kim","commit_time":"2026-03-01 00:00:00"}'

ROWS: dict[str, list[tuple]] = {
    # kim has two logins; rob is a machine's identity; pat is in two accounts; new signs up without an account
    "users": [
        ("kim", "Kim@nimbus.io", "2025-01-01 00:00:00"), ("kim2", "kim@NIMBUS.io", "2025-06-01 00:00:00"),
        ("rob", "rob@nimbus.io", "2025-01-02 00:00:00"), ("pat", "pat@kite.com", "2025-01-03 00:00:00"),
        ("lou", "lou@kite.com", "2025-01-04 00:00:00"), ("new", "new@start.up", "2025-01-05 00:00:00"),
    ],
    "organizations": [
        ("o_nim", "Nimbus", "2025-01-01 00:00:00", "Enterprise"), ("o_kite", "Kite", "2025-01-01 00:00:00", "Pro"),
        ("o_fall", "Fallback", "2025-01-01 00:00:00", "free"), ("o_new", "Startup", "2025-01-01 00:00:00", "Free"),
    ],
    "members": [
        ("o_nim", "kim", "2025-01-01 00:00:00"), ("o_nim", "kim2", "2025-06-01 00:00:00"),
        ("o_nim", "rob", "2025-01-02 00:00:00"), ("o_nim", "pat", "2025-01-03 00:00:00"),
        ("o_kite", "pat", "2025-01-03 00:00:00"), ("o_kite", "lou", "2025-01-04 00:00:00"),
        ("o_new", "new", "2025-01-05 00:00:00"),
    ],
    "projects": [("p_nim", "o_nim", "N"), ("p_kite", "o_kite", "K"), ("p_fall", "o_fall", "F"), ("p_new", "o_new", "S")],
    "experiments": [
        ("e1", "p_nim", "kim", "2026-03-20 10:00:00", REPO % "true", '{"eval_name":"x"}'),
        ("e2", "p_nim", "rob", "2026-03-21 02:00:00", REPO % "false", '{"ci_run_id":"r1"}'),
        ("e3", "p_nim", "rob", "2026-03-22 02:00:00", REPO % "false", '{"ci_run_id":"r2"}'),
        ("e4", "p_kite", "lou", "2026-03-22 02:00:00", "", '{"source":"lambda"}'),
        ("e5", "p_kite", "pat", "2026-03-23 10:00:00", REPO % "true", ""),
        ("e6", "p_nim", "kim2", "2026-03-24 10:00:00", "", ""),
        ("e7", "p_new", "new", "2026-03-25 10:00:00", REPO % "true", ""),
    ],
    "datasets": [("d1", "p_kite", "lou", "2026-03-25 10:00:00", '{"source":"manual"}')],
    "prompts": [("r1", "p_kite", "pat", "2026-01-25 10:00:00")],
    "segment_pages": [("a", "kim", "2026-03-20 09:00:00", "/x"), ("a", "", "2026-03-20 09:00:00", "/x"),
                      ("b", "lou", "2026-02-20 09:00:00", "/y")],
    "cli_wizard": [("lou", "2026-03-26 09:00:00"), ("pat", "2026-03-26 09:00:00")],
    "docs_mcp_events": [("kim", "2026-03-27 09:00:00", "install_mcp_server")],
    "api_keys": [("k1", "rob", "o_nim", "h1", "ci-runner"), ("k2", "kim", "o_nim", "h2", "kim-cli"),
                 ("k3", "kim2", "o_nim", "h3", "laptop")],
    "trace_volume": [("o_nim", "2026-03-24", "10"), ("o_nim", "2026-03-31", "11"), ("o_kite", "2026-03-24", "2"),
                     ("o_kite", "2026-03-31", "5")],
    "salesforce_accounts": [
        ("A_NIM", "Nimbus Corp", "nimbus.io", "https://www.linkedin.com/company/nimbus", "NYSE:NMB"),
        ("B_KITE", "Kite", "", "https://www.linkedin.com/company/kite", ""),
        ("C_FALL", "Fallback", "shared.com", "", ""), ("D_TWIN", "Twin", "shared.com", "https://linkedin.com/company/twin", ""),
        ("E_BARE", "Bare Metal", "", "", ""),
    ],
    "account_org_map": [("o_nim", "A_NIM", "contract"), ("o_kite", "B_KITE", "billing_parent"),
                        ("o_fall", "C_FALL", "org_c_fallback")],
    "signal_companies": [
        ("c_nim", "Nimbus Corporation", "https://www.nimbus.io/", "https://uk.linkedin.com/company/nimbus/", "nimbus.io"),
        ("c_kite", "Kite LLC", "http://kite.com/p", "https://www.linkedin.com/company/kite", ""),
        ("c_twin", "Fallback Inc", "shared.com", "https://linkedin.com/company/twin", ""),     # name says C_FALL
        ("c_clash", "Clash", "nimbus.io", "https://linkedin.com/company/kite", ""),
        ("c_bare", "Bare Metal", "", "", ""), ("c_free", "Free Agent", "https://free.agent", "", ""),
    ],
    "news_events": [
        ("n1", "c_nim", "launches", "Nimbus launches Cumulus", "2026-03-20 00:00:00", "0.9", "Cumulus", "u"),
        ("n2", "c_kite", "hires", "Kite hires, says \"wow\"", "2026-03-21 00:00:00", "0.69", "", "u"),
        ("n3", "c_kite", "hires", "Somebody else hires", "2026-03-22 00:00:00", "0.95", "", "u"),
        ("n4", "c_twin", "hires", "Fallback hires", "2026-03-23 00:00:00", "0.95", "", "u"),
        ("n5", "c_free", "raises", "Free Agent raises money", "2026-03-24 00:00:00", "0.95", "", "u"),
        ("n6", "c_kite", "expands", "Kite expands", "2026-03-01 00:00:00", "", "", "u"),
    ],
    "products": [("q1", "c_nim", "cumulus ", "x", "2026-03-19 00:00:00", "u"), ("q2", "c_kite", "Tail", "x", "2026-03-25 00:00:00", "u")],
    "tech_detections": [("t1", "c_nim", "Spark", "2026-03-01 00:00:00", "0.9"), ("t2", "c_nim", "Arrow", "2026-03-01 00:00:00", "0.8")],
}


def write_csv(folder) -> str:
    for source, columns in DELIVERED.items():
        with open(f"{folder}/raw_{source}.csv", "w", newline="") as f:
            out = csv.writer(f)
            out.writerow(columns.split())
            out.writerows(ROWS[source])
    return str(folder)
