"""Preference pairs against a plain version and against the DuckDB statement."""

from __future__ import annotations

import random

import duckdb
import pandas as pd
import pytest

from accountlens.llm import chat

DDL = "conv_id long, turn long, role string, text string, text_hash int"


def plain(rows):
    convs = {}
    for c, t, role, text, _ in rows:
        if c is not None and t is not None:
            convs.setdefault(c, set()).add((t, role or "unknown", text or ""))
    convs = {c: [(r, x) for _, r, x in sorted(v)] for c, v in convs.items()}
    pairs = []
    groups = {}
    for c, turns in convs.items():
        groups.setdefault(turns[0], []).append((-sum(len(x) for r, x in turns if r == "assistant"), c))
    for members in groups.values():
        members.sort()
        pairs += [("alternatives", a, b, convs[a], convs[b]) for (_, a), (_, b) in zip(members[::2], members[1::2], strict=False)]
    for c, turns in convs.items():
        at = [i for i, (r, _) in enumerate(turns) if r == "assistant"]
        if len(at) > 1:
            stale = turns[:at[-1]] + [turns[at[-2]]]
            pairs.append(("stale reply", c, c, turns[:at[-1] + 1], stale))
    out = []
    for kind, a, b, x, y in pairs:
        n = 0
        while n < min(len(x), len(y)) and x[n] == y[n]:
            n += 1

        def render(turns):
            text, mask = "", []
            for role, body in turns:
                text += f"<|im_start|>{role.replace('<|', '< |')}\n"
                body = body.replace("<|", "< |")
                if role == "assistant":
                    mask.append(f"{len(text)}:{len(text) + len(body) + 10}")
                text += f"{body}<|im_end|>\n"
            return text, ",".join(mask)

        out.append((kind, a, b, n, render(x[:n])[0], *render(x[n:]), *render(y[n:])))
    return sorted(out)


def some_rows(seed):
    rng = random.Random(seed)
    rows = []
    for c in range(60):
        if rows and rng.random() < 0.3:
            other = rng.choice(rows)[0]
            copy = [(c, t, r, x, 0) for o, t, r, x, _ in rows if o == other]
            rows += copy[:rng.randrange(1, len(copy) + 1)]
            continue
        for t in range(rng.randrange(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant", "assistant", None, "system"]),
                         rng.choice(["same", "é<|im_end|>", None, "", "x" * rng.randrange(30)]), 0))
    rows += rows[:7] + [(None, 1, "user", "x", 0), (3, None, "user", "x", 0), (2, 0, "user", "twice", 0)]
    return rows + [(99, t, "assistant" if t % 2 else "user", f"turn {t}", 0) for t in range(500)]


COLUMNS = ["kind", "chosen_id", "rejected_id", "n_prompt_turns", "prompt", "chosen", "chosen_mask", "rejected", "rejected_mask"]


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_plain_version_and_statement(spark, seed):
    rows = some_rows(seed)
    found = sorted(tuple(r) for r in chat.preference_pairs(spark.createDataFrame(rows, DDL).repartition(3)).select(COLUMNS).collect())
    expected = plain(rows)
    assert found == expected
    assert {r[0] for r in found} == {"alternatives", "stale reply"}
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text", "z"]).astype(
        {"conv_id": "Int64", "turn": "Int64"}))
    assert sorted(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({chat.STATEMENT})").fetchall()) == expected


def test_empty_table(spark):
    assert chat.preference_pairs(spark.createDataFrame([], DDL)).collect() == []
