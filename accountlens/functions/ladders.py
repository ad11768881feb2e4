"""Classification ladders: the ordered rules that label a record. First true rule wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from accountlens.functions.measures import truthy

# Plan names and their rank.
PLAN_RANK = {"enterprise": 3, "pro": 2, "free": 1}


def ladder(*steps: tuple[Column, Column | str], otherwise: Column | str | None = None) -> Column:
    """Chain of (condition, label); a null condition is false."""
    out = None
    for condition, label in steps:
        value = label if isinstance(label, Column) else F.lit(label)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    if otherwise is not None:
        out = out.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))
    return out


def plan_rank(plan: Column) -> Column:
    return ladder(*[(plan == p, F.lit(r)) for p, r in PLAN_RANK.items()], otherwise=F.lit(0))


def plan_of_rank(rank: Column) -> Column:
    return ladder(*[(rank == r, p) for p, r in PLAN_RANK.items()])


def ci_author(author: Column) -> Column:
    who = F.lower(author)
    return who.contains("ci-runner") | who.contains("[bot]")


def ci_source(source: Column) -> Column:
    return F.lower(source).startswith("ci")


def ci_flag(flag: Column) -> Column:
    return F.lower(flag).isin("true", "1", "yes")


def is_ci(run_id: Column, flag: Column, source: Column, author: Column) -> Column:
    """A CI job made this object; never null."""
    return truthy(run_id.isNotNull()) | truthy(ci_flag(flag)) | truthy(ci_source(source)) | truthy(ci_author(author))


def is_cli_named(key_name: Column) -> Column:
    return F.lower(key_name).contains("cli")


def is_automation_named(key_name: Column) -> Column:
    name = F.lower(key_name)
    return (name.startswith("ci-") | name.endswith("-ci")
            | name.contains("service") | name.contains("bot"))
