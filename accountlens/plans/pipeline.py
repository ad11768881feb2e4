"""All jobs wired together over one set of delivered tables."""

from __future__ import annotations

import time
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from accountlens.config import DEFAULTS, Settings
from accountlens.functions.measures import in_lookback, truthy
from accountlens.operators.lists import listed
from accountlens.plans import account360 as A
from accountlens.plans import check_suite as S
from accountlens.plans import resolution as R
from accountlens.plans.account_signals import account_signals
from accountlens.plans.activity import classified_events, product_activity
from accountlens.plans.adoption import account_surface_adoption
from accountlens.plans.companies import net_new_prospects, signal_companies
from accountlens.plans.external import external_signals, one_stream
from accountlens.plans.identity import api_key_hints, build_memberships, resolve_member_accounts, resolve_user_identity
from accountlens.plans.match_keys import account_names, build_match_keys, normalised_entities
from accountlens.plans.members import member_surface_activity, members
from accountlens.plans.orgs import org_links, resolve_org_accounts
from accountlens.plans.reports import cli_answer
from accountlens.plans.scorecard import resolution_quality
from accountlens.plans.trends import account_trace_trend, org_trace_trend, tracing_orgs
from accountlens.sources.rules import load_rules
from accountlens.sources.staging import DELIVERED, rejects, stage, staging_balance
from accountlens.sources.storage import WRITERS, Published, Relay, Scratch, register_view

# Tables read by several jobs, and the ones each of them reads, which stand before it.
SHARED = {
    "identity": [], "org_accounts": [], "entities": [], "stream": [], "match_keys": ["entities"],
    "memberships": ["identity", "org_accounts"], "matched_keys": ["match_keys"], "account_trend": ["org_accounts"],
    "companies": ["match_keys", "matched_keys"], "people": ["identity", "memberships"],
    "signals": ["stream", "match_keys", "companies"], "activity": ["identity", "people", "org_accounts"],
    "ranks": ["match_keys", "signals", "account_trend", "org_accounts", "activity"],
}
# What the other jobs read, shared tables or not.
READS = {
    "account_names": ["match_keys"], "api_keys": ["identity"], "candidates": ["matched_keys"],
    "account_keys": ["match_keys"], "company_keys": ["match_keys"],
    "person_logins": ["identity"], "person_orgs": ["memberships"], "person_accounts": ["memberships"],
    "person_api_keys": ["api_keys"], "account_orgs": ["org_accounts"], "account_tracing_orgs": ["org_accounts"],
    "account_tech": ["signals"], "action_reasons": ["feed"], "review_queue": ["match_keys", "companies"],
    "member_surfaces": ["people", "activity"],
    "members": ["people", "member_surfaces", "api_keys"],
    "adoption": ["account_names", "memberships", "activity", "account_trend"],
    "feed": ["signals", "account_trend", "org_accounts", "activity", "account_names"],
    "signal_companies": ["companies", "signals", "account_names"],
    "account_360": ["match_keys", "org_accounts", "adoption", "activity", "memberships", "people", "account_trend",
                    "companies", "signals", "feed", "review_queue", "ranks"],
    "prospects": ["signal_companies", "signals", "org_accounts", "memberships", "identity", "activity"],
    "quality": ["identity", "org_accounts", "people", "activity", "companies", "signals", "match_keys"],
    "cli_answer": ["adoption"],
}
# What a run publishes. Every list of a person, org or account stands in a long table of its own.
RESOLVED = ["identity", "org_accounts", "org_trend", "match_keys", "memberships", "api_keys", "account_trend",
            "candidates", "account_keys", "people", "companies", "activity", "signals", "org_candidates", "rejects"]
MARTS = ["member_surfaces", "members", "adoption", "feed", "signal_companies", "account_360", "prospects", "quality"]
# The activity of the lookback window is read more often than all of it.
_PARTITIONED = {"activity": ["is_in_lookback"]}


class Pipeline:
    """``build`` writes shared tables, ``plan`` is lazy and writes nothing, ``table`` builds what a plan needs first.

    Used as a context manager, or with ``close``, a run removes its scratch tables when it is done.
    """

    def __init__(self, spark: SparkSession, sources: dict[str, DataFrame], cfg: Settings = DEFAULTS,
                 rule_paths: dict[str, str] | None = None):
        self.spark, self.sources, self.cfg = spark, sources, cfg
        self._rule_paths = rule_paths or {}
        # Shared table -> its path, or its name and the publication that it belongs to; and its schema.
        self._saved: dict[str, tuple[str, Published | None, StructType]] = {}
        self._published: Published | None = None
        # What the checks on single rows have counted while a table was written.
        self._counts: dict[str, S.Counts] = {}
        # Shared tables that are being made in steps.
        self._relays: dict[str, Relay] = {}

    @cached_property
    def scratch(self) -> Scratch:
        return Scratch(self.spark)

    def close(self) -> None:
        """Remove the scratch tables; DataFrames that read them are no longer valid."""
        if "scratch" in self.__dict__:
            self.scratch.remove()
        self._saved.clear()
        self._counts.clear()

    def __enter__(self) -> Pipeline:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def rules(self, name: str) -> DataFrame:
        return load_rules(self.spark, name, self._rule_paths.get(name))

    def staged(self, source: str) -> DataFrame:
        return stage(self.sources[source], source)

    def plan(self, name: str) -> DataFrame:
        """A lazy DataFrame over the shared tables, which ``build`` has written."""
        if name.startswith("stg_"):
            return self.staged(name.removeprefix("stg_"))
        if name.startswith("rule_"):
            return self.rules(name.removeprefix("rule_"))
        if name not in SHARED:
            return getattr(self, f"_{name}")()
        if name not in self._saved:
            raise LookupError(f"build {name!r} first")
        return self._read(name)

    def _read(self, name: str) -> DataFrame:
        place, published, schema = self._saved[name]
        if published is None:
            return self.spark.read.schema(schema).parquet(place).select(*schema.names)
        saved = published.read(place)
        if name == "activity":
            # The same answer from the day that the table is cut by: a filter on it opens the files of these days only.
            saved = saved.withColumn("is_in_lookback", truthy(in_lookback(F.col("activity_day"), self.cfg)))
        return saved.select(*schema.names)

    def table(self, name: str) -> DataFrame:
        self.build([name])
        return self.plan(name)

    def build(self, names: Iterable[str] = tuple(SHARED)) -> None:
        """Write the shared tables that ``names`` need, independent ones at the same time, each once."""
        missing: set[str] = set()

        def need(name: str) -> None:
            if name not in self._saved and name not in missing:
                if name in SHARED:
                    missing.add(name)
                for n in SHARED.get(name, READS.get(name, [])):
                    need(n)

        for name in names:
            need(name)
        if not missing:
            return
        self.scratch  # noqa: B018 - made before several threads ask for it
        writes = {}

        def write(name: str) -> None:
            for n in SHARED[name]:
                if n in writes:
                    writes[n].result()
            df = getattr(self, f"_{name}")()
            self._write(name, df, self._published if name in RESOLVED else None)

        # Submitted in the order of SHARED, a table only ever waits for tables submitted before it.
        with ThreadPoolExecutor(WRITERS) as pool:
            for name in SHARED:
                if name in missing:
                    writes[name] = pool.submit(inheritable_thread_target(self.spark)(write), name)
            for w in writes.values():
                w.result()

    def _write(self, name: str, df: DataFrame, published: Published | None) -> None:
        """Write a table where it belongs, and keep what its checks have counted on the way."""
        schema, cut = df.schema, _PARTITIONED.get(name, [])
        if published and name == "activity":
            # Activity is read by date; keys without a time get a partition of their own. The hint gathers each day in
            # few files and splits days that are too large for one task.
            df, cut = df.withColumn("activity_day", F.col("activity_at").cast("date")).hint("rebalance", "activity_day"), ["activity_day"]
        df, counts = S.watched(df, name)
        if published:
            place = published.add(df, "cleansed" if name in RESOLVED else "unified", name, cut)
        else:
            place = self.scratch.write(df, name, cut)
        if name in self._relays:
            self._relays.pop(name).end()
        self._saved[name] = place, published, schema
        self._counts[name] = counts()

    def saved(self, name: str) -> DataFrame:
        """A table as it was written; a mart is written once, by the first that asks for it."""
        if name in SHARED or name not in RESOLVED + MARTS:
            return self.table(name)
        if name not in self._saved:
            self._write(name, self.table(name), None)
        return self._read(name)

    def counts(self, name: str) -> S.Counts | None:
        """What the write of a table has counted, None for a table that is not written."""
        if name in SHARED or name in RESOLVED + MARTS:
            self.saved(name)
        return self._counts.get(name)

    # What staging leaves out.
    def _rejects(self):
        return reduce(DataFrame.unionByName, [rejects(self.sources[s], s) for s in DELIVERED])

    def staging_balance(self) -> DataFrame:
        """(source, rows_in, rows_staged, rows_rejected): in = staged + rejected, for each source."""
        return reduce(DataFrame.unionByName, [staging_balance(self.sources[s], s) for s in DELIVERED])

    # Make comparable.
    def _identity(self):
        return resolve_user_identity(self.staged("users"))

    def _org_accounts(self):
        return resolve_org_accounts(self.staged("organizations"), self.staged("account_org_map"),
                                    self.staged("salesforce_accounts"), self.rules("org_mapping_sources"), self.cfg)

    def _org_trend(self):
        return org_trace_trend(self.staged("trace_volume"), self.cfg)

    def _match_keys(self):
        return build_match_keys(self.plan("entities"), self.cfg)

    def _entities(self):
        return normalised_entities(self.staged("salesforce_accounts"), self.staged("signal_companies"))

    def _stream(self):
        return one_stream(self.staged("news_events"), self.staged("products"), self.staged("tech_detections"))

    def _org_candidates(self):
        return org_links(self.staged("account_org_map"), self.staged("salesforce_accounts"),
                         self.rules("org_mapping_sources"), self.cfg)

    def _account_names(self):
        return account_names(self.plan("match_keys"))

    # Relate.
    def _memberships(self):
        return build_memberships(self.staged("members"), self.plan("identity"), self.plan("org_accounts"))

    def _api_keys(self):
        return api_key_hints(self.staged("api_keys"), self.plan("identity"))

    def _account_trend(self):
        return account_trace_trend(self.plan("org_trend"), self.plan("org_accounts"), self.cfg)

    def _matched_keys(self):
        return R.matched_keys(self.plan("match_keys"), self.rules("external_match_rules"))

    def _candidates(self):
        return R.match_candidates(self.plan("matched_keys"))

    def _account_keys(self):
        return R.account_keys(self.plan("match_keys"))

    def _company_keys(self):
        return R.company_keys(self.plan("match_keys"))

    # Lists, one row for each value.
    def _person_logins(self):
        return listed(self.plan("identity"), ["person_id"], "user_id", "user_id")

    def _person_orgs(self):
        return listed(self.plan("memberships"), ["person_id"], "org_id", "org_id")

    def _person_accounts(self):
        return listed(self.plan("memberships"), ["person_id"], "account_id", "account_id")

    def _person_api_keys(self):
        return listed(self.plan("api_keys").filter("person_id IS NOT NULL"), ["person_id"], "key_name", "key_name")

    def _account_orgs(self):
        return listed(self.plan("org_accounts").filter("account_id IS NOT NULL"), ["account_id"], "org_id", "org_id")

    def _account_tracing_orgs(self):
        return tracing_orgs(self.plan("org_trend"), self.plan("org_accounts"))

    def _account_tech(self):
        return A.tech_stack(self.plan("signals"))

    def _action_reasons(self):
        return A.action_reasons(self.plan("feed"))

    # Decide.
    def _people(self):
        return resolve_member_accounts(self.plan("identity"), self.plan("memberships"))

    def _companies(self):
        return R.resolve_companies(self.plan("match_keys"), self.plan("matched_keys"),
                                   R.account_keys(self.plan("match_keys")), self.cfg)

    # Classify.
    def _activity(self):
        sources = {s: self.staged(s) for s in ("experiments", "datasets", "prompts", "segment_pages",
                                               "cli_wizard", "docs_mcp_events")}
        relay = self._relays["activity"] = Relay(self.scratch, "activity")
        events = classified_events(sources | {"api_keys": self.plan("api_keys")}, relay)
        return product_activity(events, self.staged("projects"), self.plan("identity"), self.plan("people"),
                                self.plan("org_accounts"), self.rules("surface_signals"), self.cfg, relay)

    def _signals(self):
        return external_signals(self.plan("stream"), self.plan("match_keys"), self.plan("companies"), self.cfg)

    def _review_queue(self):
        return R.review_queue_sizes(self.plan("match_keys"), self.plan("companies"))

    def _ranks(self):
        return A.account_ranks(self.plan("account_names"), self.plan("feed"), self.plan("account_trend"), self.scratch)

    # Marts and reports.
    def _member_surfaces(self):
        return member_surface_activity(self.plan("people"), self.plan("activity"))

    def _members(self):
        return members(self.plan("people"), self.plan("member_surfaces"), self.plan("api_keys"))

    def _adoption(self):
        return account_surface_adoption(self.plan("account_names"), self.plan("memberships"), self.plan("activity"),
                                        self.plan("account_trend"), self.rules("surface_signals"))

    def _feed(self):
        return account_signals(self.plan("signals"), self.plan("account_trend"), self.plan("org_accounts"),
                               self.plan("activity"), self.plan("account_names"), self.rules("surface_signals"),
                               self.cfg)

    def _signal_companies(self):
        return signal_companies(self.plan("companies"), self.plan("signals"), self.plan("account_names"))

    def _account_360(self):
        inputs = ["match_keys", "org_accounts", "adoption", "activity", "memberships", "people", "account_trend",
                  "companies", "signals", "feed", "review_queue", "ranks"]
        return A.account_360(*[self.plan(n) for n in inputs], self.cfg)

    def _prospects(self):
        return net_new_prospects(self.plan("signal_companies"), self.plan("signals"), self.plan("org_accounts"),
                                 self.plan("memberships"), self.plan("identity"), self.plan("activity"))

    def _quality(self):
        return resolution_quality({
            "identity": self.plan("identity"), "orgs": self.plan("org_accounts"), "people": self.plan("people"),
            "activity": self.plan("activity"), "pages": self.staged("segment_pages"),
            "companies": self.plan("companies"), "signals": self.plan("signals"),
            "accounts": self.plan("match_keys").filter("entity_type = 'account'")})

    def _cli_answer(self):
        return cli_answer(self.plan("adoption"))

    def publish(self, env: str = "prod") -> list[str]:
        """Write resolved tables and marts, each once, and make them what the permanent views show: the views' names.

        Every run writes parts of its own; one pointer is moved when all are written, so a reader sees the run before or
        this one as a whole. Staging stays a set of lazy views of the session, as its sources may be files.
        """
        for source in DELIVERED:
            register_view(self.staged(source), "raw", f"stg_{source}", env)
        published = self._published = Published(self.spark, env, f"{time.time_ns():020d}")
        built = set(self._saved)
        self.build([*RESOLVED, *MARTS])
        for name in RESOLVED:
            # Tables that this run has just built stand where they belong.
            if name not in SHARED or name in built:
                self._write(name, self.plan(name), published)
        for name in MARTS:
            self._write(name, self.plan(name), published)
        self._published = None
        return published.show()

    def visible(self, env: str = "prod") -> str | None:
        """The run that readers of the views see."""
        return Published(self.spark, env, "").current()
