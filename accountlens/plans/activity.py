"""Every product event in one shape: which surface, what kind of proof, how sure, who acted.

The events are moved three times: to be kept once, to meet their place, and to meet their person. On the way they are
``packed``: what all events of a source have in common, and labels of fixed lists, are small numbers, and no id is held twice.
With a ``Relay`` they are written after each move, so that the shuffle files of one are gone before the next.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountlens.config import DEFAULTS, Settings
from accountlens.functions.ladders import ci_author, ci_flag, ci_source, is_ci, ladder
from accountlens.functions.measures import in_lookback, truthy
from accountlens.operators.dedupe import keep_first
from accountlens.operators.joins import lookup
from accountlens.sources.storage import Relay

OBJECTS = ("experiment", "dataset", "prompt")
RESOLVED = ("resolved", "resolved_low_confidence")


def _id(prefix: str, *parts: Column) -> Column:
    """Event id from its parts; a missing part is blank, so events never merge for want of a value."""
    return F.concat_ws(":", F.lit(prefix), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def _event(df: DataFrame, source: str, kind: str, *, activity_id: Column, at: Column,
           signal: Column | str, actor: Column | str, detail: Column | str,
           object_id: Column | None = None, project: bool = False, org: bool = False) -> DataFrame:
    def text(c: Column | str | None) -> Column:
        return F.lit(c).cast("string") if c is None or isinstance(c, str) else c

    return df.select(
        activity_id.alias("activity_id"), F.lit(source).alias("source_table"), F.lit(kind).alias("activity_type"),
        text(object_id).alias("object_id"), "user_id",
        (F.col("project_id") if project else text(None)).alias("project_id"),
        (F.col("org_id") if org else text(None)).alias("direct_org_id"),
        at.cast("timestamp_ntz").alias("activity_at"),
        text(signal).alias("signal_code"), text(actor).alias("actor_type"), text(detail).alias("evidence_detail"),
    )


def _object_id(prefix: str, column: str) -> Column:
    """Null for an object without an id, which is then kept as it is."""
    return F.concat(F.lit(f"{prefix}:"), F.col(column))


def experiments(df: DataFrame) -> DataFrame:
    run, flag, source, author = (F.col(c) for c in (
        "meta_ci_run_id", "meta_ci_flag", "meta_source", "repo_author_name"))
    df = df.withColumn("by_ci", is_ci(run, flag, source, author))
    by_ci, repo, dirty = F.col("by_ci"), F.col("has_repo_info"), F.col("repo_is_dirty")
    tagged = F.concat(F.lit("metadata.source = "), source)
    untied = source.isNotNull() & ~repo
    return _event(
        df, "raw_experiments", "experiment", activity_id=_object_id("experiment", "experiment_id"),
        object_id=F.col("experiment_id"), project=True, at=F.col("created_at"),
        signal=ladder((by_ci, "code_ci_run"), (repo, "code_repo_info"),
                      (source.isNotNull(), "code_runtime_source"), otherwise="object_origin_unknown"),
        actor=ladder((by_ci, "automation"), (dirty, "human"), (untied, "automation"), (repo, "human"),
                     otherwise="unknown"),
        detail=ladder(
            (run.isNotNull(), "metadata.ci_run_id present"),
            (ci_flag(flag), "metadata.ci = true"),
            (ci_source(source), tagged),
            (ci_author(author), F.concat(F.lit("repo_info.author_name = "), author)),
            (dirty, "repo_info.dirty = true (uncommitted local run)"),
            (untied, F.concat(tagged, F.lit(" (server-side process)"))),
            (repo, "repo_info present, committed code"),
            otherwise="no repo_info, no metadata tags"),
    )


def datasets(df: DataFrame) -> DataFrame:
    source = F.col("meta_source")
    return _event(
        df, "raw_datasets", "dataset", activity_id=_object_id("dataset", "dataset_id"),
        object_id=F.col("dataset_id"), project=True, at=F.col("created_at"),
        signal=ladder((ci_source(source), "code_ci_run"), otherwise="object_origin_unknown"),
        actor=ladder((ci_source(source), "automation"), (F.lower(source) == "manual", "human"), otherwise="unknown"),
        detail=ladder((source.isNotNull(), F.concat(F.lit("metadata.source = "), source)), otherwise="no metadata"),
    )


def prompts(df: DataFrame) -> DataFrame:
    return _event(
        df, "raw_prompts", "prompt", activity_id=_object_id("prompt", "prompt_id"),
        object_id=F.col("prompt_id"), project=True, at=F.col("created_at"),
        signal="object_origin_unknown", actor="unknown", detail="prompts carry no origin metadata")


def page_views(df: DataFrame) -> DataFrame:
    """Views of signed-in people; anonymous views are counted in the scorecard."""
    return _event(
        df.filter(F.col("user_id").isNotNull()), "raw_segment_pages", "page_view",
        activity_id=_id("page_view", F.col("anonymous_id"), F.col("user_id"), F.col("viewed_at"), F.col("page_path")),
        object_id=F.col("page_path"), at=F.col("viewed_at"), signal="ui_page_view", actor="human",
        detail=F.concat(F.lit("logged-in page view: "), F.col("page_path")))


def wizard_views(df: DataFrame) -> DataFrame:
    return _event(
        df, "raw_cli_wizard", "cli_setup_wizard", activity_id=_id("cli_wizard", F.col("user_id"), F.col("event_at")),
        at=F.col("event_at"), signal="cli_setup_wizard", actor="human",
        detail="opened CLI setup wizard (browser)")


def docs_clicks(df: DataFrame) -> DataFrame:
    return _event(
        df, "raw_docs_mcp_events", "docs_mcp_click",
        activity_id=_id("docs_mcp", F.col("user_id"), F.col("event_at"), F.col("action")),
        object_id=F.col("action"), at=F.col("event_at"), signal="mcp_docs_click", actor="human",
        detail=F.concat(F.lit("docs click: "), F.col("action")))


def key_hints(df: DataFrame) -> DataFrame:
    """Keys named after the CLI. They carry no time."""
    return _event(
        df.filter("is_cli_named"), "raw_api_keys", "api_key", activity_id=_object_id("api_key", "api_key_id"),
        object_id=F.col("api_key_id"), org=True, at=F.lit(None), signal="cli_key_name_hint", actor="unknown",
        detail=F.concat(F.lit('API key named "'), F.col("key_name"), F.lit('"')))


# Source -> its classification.
CLASSIFIERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "experiments": experiments,
    "datasets": datasets,
    "prompts": prompts,
    "segment_pages": page_views,
    "cli_wizard": wizard_views,
    "docs_mcp_events": docs_clicks,
    "api_keys": key_hints,
}


# Labels of the classifiers. In the order of the texts, so that packed events are ordered as unpacked ones.
SIGNALS = ("cli_key_name_hint", "cli_setup_wizard", "code_ci_run", "code_repo_info", "code_runtime_source",
           "mcp_docs_click", "object_origin_unknown", "ui_page_view")
ACTORS = ("automation", "human", "unknown")


@dataclass(frozen=True)
class _Kind:
    """What all events of a source have in common."""

    table: str
    activity: str
    prefix: str              # of the activity id
    place: str | None = None  # column that says where: project_id or direct_org_id
    is_object: bool = False  # the activity id is the prefix and the object's id


_KINDS = {
    "experiments": _Kind("raw_experiments", "experiment", "experiment", "project_id", True),
    "datasets": _Kind("raw_datasets", "dataset", "dataset", "project_id", True),
    "prompts": _Kind("raw_prompts", "prompt", "prompt", "project_id", True),
    "segment_pages": _Kind("raw_segment_pages", "page_view", "page_view"),
    "cli_wizard": _Kind("raw_cli_wizard", "cli_setup_wizard", "cli_wizard"),
    "docs_mcp_events": _Kind("raw_docs_mcp_events", "docs_mcp_click", "docs_mcp"),
    "api_keys": _Kind("raw_api_keys", "api_key", "api_key", "direct_org_id", True),
}
# First letters of a place: what its id stands for.
_PLACE = {"project_id": "p:", "direct_org_id": "o:"}


def _code(label: Column, labels: tuple[str, ...]) -> Column:
    return F.array_position(F.array(*map(F.lit, labels)), label).cast("tinyint")


def _label(code: str, labels: Iterable[str | bool | None]) -> Column:
    return F.element_at(F.array(*map(F.lit, labels)), F.col(code).cast("int"))


def packed(events: DataFrame, source: str) -> DataFrame:
    """The classified events of a source as they travel; ``kind`` is the number of the source."""
    kind = _KINDS[source]
    null = F.lit(None).cast("string")
    return events.select(
        F.lit([*_KINDS].index(source) + 1).cast("tinyint").alias("kind"),
        F.substring("activity_id", len(kind.prefix) + 2, 2**31 - 1).alias("id"),
        "activity_at", (null if kind.is_object else F.col("object_id")).alias("object"), "user_id",
        (F.concat(F.lit(_PLACE[kind.place]), F.col(kind.place)) if kind.place else null).alias("place"),
        _code(F.col("signal_code"), SIGNALS).alias("signal"), _code(F.col("actor_type"), ACTORS).alias("actor"),
        "evidence_detail")


def _unpacked() -> dict[str, Column]:
    """The columns of a classified event from those of a packed one."""
    kinds = _KINDS.values()

    def place(column: str) -> Column:
        return F.when(F.col("place").startswith(_PLACE[column]), F.substring("place", 3, 2**31 - 1))

    return {
        "activity_id": F.concat(_label("kind", [f"{k.prefix}:" for k in kinds]), F.col("id")),
        "source_table": _label("kind", [k.table for k in kinds]),
        "activity_type": _label("kind", [k.activity for k in kinds]),
        "object_id": F.when(_label("kind", [k.is_object for k in kinds]), F.col("id")).otherwise(F.col("object")),
        "project_id": place("project_id"), "direct_org_id": place("direct_org_id"),
        "signal_code": _label("signal", SIGNALS), "actor_type": _label("actor", ACTORS),
    }


def _moved(events: DataFrame, relay: Relay | None, keys: list[str], move: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return relay.step(keys, move) if relay else move(events)


def _each_once(events: DataFrame) -> DataFrame:
    identified = events.filter(F.col("id").isNotNull())
    nameless = events.filter(F.col("id").isNull())
    return keep_first(identified, ["kind", "id"], ["activity_at"]).unionByName(nameless)


def classified_events(sources: dict[str, DataFrame], relay: Relay | None = None) -> DataFrame:
    """All events of all sources, each once, ``packed``. ``api_keys`` is the output of ``api_key_hints``."""
    events = reduce(DataFrame.unionByName, [packed(f(sources[s]), s) for s, f in CLASSIFIERS.items()])
    if relay:
        events = relay.begin(events)
    return _moved(events, relay, ["kind", "id"], _each_once)


def _places(projects: DataFrame, orgs: DataFrame) -> DataFrame:
    """What a project id or a direct org id stands for: org and the account behind it."""
    org = orgs.select("org_id", F.col("account_id").alias("org_account_id"),
                      F.col("resolution_status").alias("org_status"),
                      F.col("mapping_confidence").alias("org_confidence"))
    by_project = (
        projects.select("project_id", "org_id").join(org, "org_id", "left")
        .withColumn("place", F.concat(F.lit(_PLACE["project_id"]), F.col("project_id"))).drop("project_id"))
    by_org = org.withColumn("place", F.concat(F.lit(_PLACE["direct_org_id"]), F.col("org_id")))
    return by_project.unionByName(by_org).filter(F.col("place").isNotNull()) \
        .withColumnRenamed("org_id", "place_org_id")


def product_activity(events: DataFrame, projects: DataFrame, identity: DataFrame, people: DataFrame,
                     org_accounts: DataFrame, surface_rules: DataFrame, cfg: Settings = DEFAULTS,
                     relay: Relay | None = None) -> DataFrame:
    """One row per event with its place, person, evidence grade and account.

    Objects follow the org of their project, keys their own org, browser events the
    account of a person who has only one. ``events`` is ``classified_events``, by the same ``relay`` if there is one.
    """
    person = people.select(
        "person_id", F.col("account_id").alias("person_account_id"),
        F.col("resolution_status").alias("person_status"), F.col("account_confidence").alias("person_confidence"))
    logins = identity.select("user_id", "person_id").join(person, "person_id", "left")
    places = _places(projects, org_accounts)
    if relay:
        places, logins = relay.beside(places), relay.beside(logins)
    rules = surface_rules.select("signal_code", "surface", "evidence_kind", "attribution", "confidence_score")

    located = _moved(events, relay, ["place"], lambda some: lookup(some, places, ["place"]))
    known = _moved(located, relay, ["user_id"], lambda some: lookup(some, logins, ["user_id"]))
    joined = (
        known.withColumns(_unpacked())
        .join(rules, "signal_code", "left")
        .withColumn("org_id", F.coalesce("place_org_id", "direct_org_id"))
    )
    has_org = F.col("org_id").isNotNull()
    by_org = truthy(F.col("org_status").isin(*RESOLVED))
    by_person = truthy(F.col("person_status") == "resolved")
    return joined.select(
        "activity_id", "source_table", "activity_type", "object_id", "user_id", "person_id", "project_id",
        "org_id", "activity_at",
        truthy(in_lookback(F.col("activity_at"), cfg)).alias("is_in_lookback"),
        "signal_code", "surface", "evidence_kind", "attribution", "confidence_score", "actor_type",
        "evidence_detail",
        ladder((has_org & by_org, F.col("org_account_id")),
               (~has_org & by_person, F.col("person_account_id"))).alias("account_id"),
        ladder((has_org & by_org, "org_account"),
               (has_org, F.concat(F.lit("org_"), F.col("org_status"))),
               (by_person, "single_account_member"),
               otherwise=F.concat(F.lit("person_"), F.coalesce("person_status", F.lit("unknown"))))
        .alias("account_attribution"),
        ladder((by_org, F.col("org_confidence")),
               (~has_org & by_person, F.col("person_confidence"))).alias("account_confidence"),
    )
