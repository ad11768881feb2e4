"""The 18 delivered tables: schema as delivered, and one staging projection each.

Every delivered column arrives as text; a landed table may have typed ones. Staging trims text, turns blanks into null, renames and casts;
it holds no business rule. JSON is opened here and nowhere else.

A record is staged or rejected, never lost and never half read: a line that does not fit the file's columns, and a cell
that has text but is no value of its type, send the whole record to ``rejects`` with the reasons; ``stage`` leaves it out.
Every record is in exactly one of the two.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source table -> delivered columns.
DELIVERED = {
    "users": "user_id email created_at",
    "members": "org_id user_id member_created_at",
    "organizations": "org_id org_name created_at plan",
    "projects": "project_id org_id name",
    "experiments": "id project_id user_id created repo_info metadata",
    "datasets": "id project_id user_id created metadata",
    "prompts": "id project_id user_id created",
    "segment_pages": "anonymous_id user_id timestamp path",
    "cli_wizard": "user_id timestamp",
    "docs_mcp_events": "user_id timestamp action",
    "api_keys": "id user_id org_id key_hash name",
    "trace_volume": "org_id ds ingested_gb",
    "salesforce_accounts": "account_id account_name domain linkedin_company_url ticker",
    "account_org_map": "org_id account_id mapping_source",
    "signal_companies": "company_id company_name company_website linkedin_url linkedin_domain",
    "news_events": "id company_id category summary found_at confidence product_name source_url",
    "products": "id company_id name category first_seen_at source_url",
    "tech_detections": "id company_id technology_name first_seen_at score",
}

# Source table -> staged columns, as "target[=source][:type]"; the type is text when left out.
STAGED = {
    "users": "user_id email created_at:ts",
    "members": "org_id user_id member_created_at:ts",
    "organizations": "org_id org_name created_at:ts plan",
    "projects": "project_id org_id project_name=name",
    "experiments": "experiment_id=id project_id user_id created_at=created:ts "
                   "repo_info_json=repo_info metadata_json=metadata",
    "datasets": "dataset_id=id project_id user_id created_at=created:ts metadata_json=metadata",
    "prompts": "prompt_id=id project_id user_id created_at=created:ts",
    "segment_pages": "anonymous_id user_id viewed_at=timestamp:ts page_path=path",
    "cli_wizard": "user_id event_at=timestamp:ts",
    "docs_mcp_events": "user_id event_at=timestamp:ts action",
    "api_keys": "api_key_id=id user_id org_id key_hash key_name=name",
    "trace_volume": "org_id activity_date=ds:date ingested_gb:double",
    "salesforce_accounts": "account_id account_name domain linkedin_company_url ticker",
    "account_org_map": "org_id account_id mapping_source",
    "signal_companies": "company_id company_name company_website linkedin_url linkedin_domain",
    "news_events": "news_id=id company_id category summary found_at:ts "
                   "vendor_confidence=confidence:double product_name source_url",
    "products": "product_id=id company_id product_name=name category first_seen_at:ts source_url",
    "tech_detections": "detection_id=id company_id technology_name first_seen_at:ts vendor_score=score:double",
}

_TYPES = {"ts": "timestamp_ntz", "date": "date", "double": "double"}

#: The line as it was read, where it does not fit the columns; null for the others. Files have it, landed tables may.
CORRUPT = "_corrupt_record"


def delivered_schema(source: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in DELIVERED[source].split()])


def clean(c: Column) -> Column:
    """Text without outer spaces; blank is null."""
    return F.nullif(F.trim(c), F.lit(""))


@dataclass(frozen=True)
class _Target:
    """One staged column: its name, the delivered column it comes from, and its type if that is not text."""

    name: str
    source: str
    kind: str | None

    @staticmethod
    def of(spec: str) -> _Target:
        spec, _, kind = spec.partition(":")
        name, _, source = spec.partition("=")
        return _Target(name, source or name, _TYPES.get(kind))

    def is_landed(self, schema: T.StructType) -> bool:
        """A source column that already has a target type other than text is taken as it is, so that filters on it
        reach the scan. It cannot be wrong."""
        return self.kind is not None and schema[self.source].dataType.simpleString() == self.kind

    def _text(self) -> Column:
        return clean(F.col(f"`{self.source}`").cast("string"))

    def column(self, schema: T.StructType) -> Column:
        if self.is_landed(schema):
            return F.col(f"`{self.source}`").alias(self.name)
        return (self._text().try_cast(self.kind) if self.kind else self._text()).alias(self.name)

    def wrong(self, schema: T.StructType) -> Column | None:
        """Whether the cell has text that is no value of the type; None where that cannot be."""
        if self.kind is None or self.is_landed(schema):
            return None
        return self._text().isNotNull() & self._text().try_cast(self.kind).isNull()


def _targets(source: str) -> list[_Target]:
    return [_Target.of(s) for s in STAGED[source].split()]


def _does_not_fit(source: str) -> Column:
    """Whether ``CORRUPT`` has a line. Spark refuses to read that column of a file alone, as a count would where no cell
    can be wrong, so a delivered column, whatever it holds, is read with it."""
    beside = F.coalesce(F.col(f"`{DELIVERED[source].split()[0]}`").cast("string"), F.lit(""))
    return F.concat(F.col(CORRUPT), beside).isNotNull()


def _problems(df: DataFrame, source: str) -> list[tuple[Column, str]]:
    """What can be wrong with a record: a condition, never null, and the reason in words."""
    found = [(_does_not_fit(source), "line does not fit the columns")] if CORRUPT in df.columns else []
    for t in _targets(source):
        if (wrong := t.wrong(df.schema)) is not None:
            found.append((wrong, f"{t.source}: not a {t.kind.removesuffix('_ntz')}"))
    return found


def _field(json: str, key: str) -> Column:
    return F.get_json_object(json, f"$.{key}")


def _experiment_fields() -> dict[str, Column]:
    repo, meta = "repo_info_json", "metadata_json"
    return {
        "has_repo_info": F.col(repo).isNotNull(),
        "repo_commit": _field(repo, "commit"),
        "repo_branch": _field(repo, "branch"),
        "repo_is_dirty": _field(repo, "dirty").try_cast("boolean"),
        "repo_author_name": _field(repo, "author_name"),
        "repo_commit_time": _field(repo, "commit_time").try_cast("timestamp_ntz"),
        "meta_eval_name": _field(meta, "eval_name"),
        "meta_model": _field(meta, "model"),
        "meta_source": _field(meta, "source"),
        "meta_ci_run_id": _field(meta, "ci_run_id"),
        "meta_ci_flag": _field(meta, "ci"),
    }


def stage(df: DataFrame, source: str) -> DataFrame:
    """Delivered table -> staged table, without the records that ``rejects`` has."""
    for wrong, _ in _problems(df, source):
        df = df.filter(~wrong)
    staged = df.select(*[t.column(df.schema) for t in _targets(source)])
    if source == "experiments":
        staged = staged.withColumns(_experiment_fields())
    elif source == "datasets":
        staged = staged.withColumn("meta_source", _field("metadata_json", "source"))
    return staged


def rejects(df: DataFrame, source: str) -> DataFrame:
    """(source, reasons, record): the records that are not staged, each as it was delivered.

    ``record`` is the line of a file that does not fit, else the delivered columns as JSON.
    """
    problems = _problems(df, source)
    if not problems:
        return df.sparkSession.createDataFrame([], "source string, reasons string, record string")
    delivered = F.to_json(F.struct(*[F.col(f"`{c}`") for c in DELIVERED[source].split()]))
    line = F.col(CORRUPT) if CORRUPT in df.columns else F.lit(None).cast("string")
    return df.filter(reduce(lambda a, b: a | b, [wrong for wrong, _ in problems])).select(
        F.lit(source).alias("source"),
        F.concat_ws("; ", *[F.when(wrong, reason) for wrong, reason in problems]).alias("reasons"),
        F.coalesce(line, delivered).alias("record"))


def staging_balance(df: DataFrame, source: str) -> DataFrame:
    """(source, rows_in, rows_staged, rows_rejected) of one source, counted on the three tables themselves."""
    parts = {"rows_in": df, "rows_staged": stage(df, source), "rows_rejected": rejects(df, source)}
    tagged = reduce(DataFrame.union, [t.select(F.lit(name).alias("part")) for name, t in parts.items()])
    return tagged.agg(*[F.count_if(F.col("part") == name).alias(name) for name in parts]).select(
        F.lit(source).alias("source"), *parts)


def read_csv_source(spark: SparkSession, path: str, source: str) -> DataFrame:
    """A delivered CSV file, every column as text, and ``CORRUPT`` for lines with too few or too many cells.

    Lines are always parsed whole: with fewer columns asked for, Spark would not see that a line does not fit.
    """
    schema = T.StructType([*delivered_schema(source), T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        .option("header", True).option("escape", '"').option("enforceSchema", False).option("columnPruning", False)
        .csv(path)
    )


def read_table_source(spark: SparkSession, table: str | None = None, path: str | None = None) -> DataFrame:
    """A landed table by name, or Parquet by path."""
    return spark.table(table) if table else spark.read.parquet(path)


def csv_sources(spark: SparkSession, folder: str, prefix: str = "raw_") -> dict[str, DataFrame]:
    """All delivered CSV files of a folder, by source name."""
    return {s: read_csv_source(spark, f"{folder}/{prefix}{s}.csv", s) for s in DELIVERED}
