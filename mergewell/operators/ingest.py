"""From raw pages to typed records: registries of adapters and parsers, the personal-data step and the run over all sources."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mergewell.functions import dates, location, text
from mergewell.operators import records
from mergewell.operators.provenance import as_text
from mergewell.sources import pages as shapes

#: Fields under which personal identifiers arrive.
RAW_IDENTIFIERS = ("cedula", "cédula", "identity_document", "documento_identidad", "telefono", "teléfono", "phone", "mobile", "celular")
#: Version of the normalising rules, written on every record.
NORMALIZER_VERSION = "1"


class Adapter(Protocol):
    """Reads the pages of a source: (spark, source) to rows with source_id, source_url, page, raw_content."""

    def __call__(self, spark: SparkSession, source: dict) -> DataFrame: ...


class Parser(Protocol):
    """Turns raw pages into typed records and rows that could not become one: (good, bad); bad has body and reason_code."""

    def __call__(self, pages: DataFrame) -> tuple[DataFrame, DataFrame]: ...


ADAPTERS: dict[str, Adapter] = {}
PARSERS: dict[str, Parser] = {}


def adapter(kind: str) -> Callable[[Adapter], Adapter]:
    """Registers the adapter of a source type."""

    def register(f: Adapter) -> Adapter:
        ADAPTERS[kind] = f
        return f

    return register


def parser(name: str) -> Callable[[Parser], Parser]:
    """Registers a parser under the name that sources assign."""

    def register(f: Parser) -> Parser:
        PARSERS[name] = f
        return f

    return register


def adapter_for(source: dict, expected: str | None = None) -> Adapter | None:
    """The adapter of the source's type, null where none is registered; an error where the source is of another type than expected."""
    if expected is not None and source.get("type") != expected:
        raise ValueError(f"source {source.get('id')} is of type {source.get('type')}, not {expected}")
    return ADAPTERS.get(source.get("type"))


def parser_for(source: dict) -> Parser | None:
    return PARSERS.get(source.get("parser_asignado"))


@adapter("api_json")
def read_api(spark: SparkSession, source: dict) -> DataFrame:
    reader = spark.read.format("paged_json").option("url", source["url"])
    for option, field in (("pageSize", "page_size"), ("probeLimit", "probe_limit"), ("perMinute", "rate_limit_per_minute")):
        if source.get(field):
            reader = reader.option(option, str(source[field]))
    rows = reader.load()
    return rows.select(F.lit(source["id"]).alias("source_id"), "source_url", F.floor(F.col("offset") / F.greatest(F.col("page_limit"), F.lit(1))).cast("int").alias("page"), F.concat(F.lit('{"items":['), "record", F.lit("]}")).alias("raw_content"))


@adapter("manual_file")
def read_files(spark: SparkSession, source: dict) -> DataFrame:
    return shapes.text_files(spark, source["url"]).select(F.lit(source["id"]).alias("source_id"), "source_url", F.lit(1).alias("page"), F.col("raw_text").alias("raw_content"))


@parser("persons_api")
def parse_api(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return shapes.api_persons(rows)


@parser("posts")
def parse_posts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    read = shapes.posts(rows, "raw_content")
    nothing = F.col("status").isNull() & F.col("full_name").isNull()
    return read.where(~nothing), read.where(nothing).select(F.col("raw_content").alias("body"), F.lit("invalid_schema").alias("reason_code"))


@parser("demo")
def parse_demo(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    named = F.regexp_extract("raw_content", shapes.DEMO_NAME, 1) != ""
    bad = rows.where(~F.coalesce(named, F.lit(False))).select(F.col("raw_content").alias("body"), F.lit("invalid_schema").alias("reason_code"))
    return shapes.demo_persons(rows), bad


def source_key(url: Column) -> Column:
    """Host and port of a web address, else the file's name without its ending."""
    stem = F.regexp_replace(F.regexp_extract(url, r"([^/\\]*)$", 1), r"(?<=.)\.[^.]*$", "")
    return F.when(url.rlike("(?i)^https?://"), F.lower(F.try_parse_url(url, F.lit("AUTHORITY")))).otherwise(stem)


def positive_int(value, default: int) -> int:
    """value as a whole number of 1 or more, else default."""
    try:
        number = int(value)
    except (TypeError, ValueError):
        return default
    return number if number >= 1 and not isinstance(value, bool) else default


def parse_typed(pages: DataFrame, schema: str, body: str = "raw_content") -> tuple[DataFrame, DataFrame]:
    """Pages as records of a schema, and pages that are no JSON of it as quarantine rows of reason invalid_schema: no page is lost."""
    read = pages.withColumn("parsed", F.from_json(body, f"{schema.removesuffix('>')},_corrupt:string>", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    failed = F.col("parsed").isNull() | F.col("parsed._corrupt").isNotNull()
    bad = read.where(failed).select("source_id", as_text(pages, body).alias("body"), F.lit("invalid_schema").alias("reason_code"), F.lit("medium").alias("risk_level"))
    return read.where(~failed).select("source_id", "parsed.*").drop("_corrupt"), bad


def apply_pii(rows: DataFrame, secret: str | None, entity_type: str, record_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Records without raw identifiers, and those whose identifiers could not be treated.

    With a secret, each identifier column becomes its token and mask; without one it is dropped and the
    record goes on. An identifier that holds letters or digits in no script that normalises leaves no
    token: such a record is rescued without it if it has a name, else it is quarantined (pii_untreatable,
    high). Every row comes out on one side. Columns entity_type and, where record_id is given, source_record_id are added.
    """
    have = [c for c in rows.columns if c.lower() in RAW_IDENTIFIERS]
    named = F.coalesce(F.trim(F.col("full_name")) != "", F.lit(False)) if "full_name" in rows.columns else F.lit(True)
    untreated = F.lit(False)
    for c in have if secret else []:
        given = F.coalesce(F.trim(F.col(c).cast("string")) != "", F.lit(False))
        untreated = untreated | (given & (text.normalize_identifier(F.col(c).cast("string")) == ""))
    body = F.to_json(F.struct(*[F.col(c) for c in sorted(rows.columns)]))
    bad = rows.where(untreated & ~named).select(body.alias("body"), F.lit("pii_untreatable").alias("reason_code"), F.lit("high").alias("risk_level"))
    good = rows.where(~(untreated & ~named))
    if secret and have:
        good = records.tokenise_identifiers(good, {c: (c,) for c in have}, secret)
    good = good.drop(*have).withColumn("entity_type", F.lit(entity_type))
    return (good.withColumn("source_record_id", F.col(record_id).cast("string")) if record_id and record_id in good.columns else good), bad


def enrich_records(rows: DataFrame, name: str = "full_name", place: str = "last_known_location", synonyms: dict[str, str] | None = None) -> DataFrame:
    """Rows with the rules' version, a canonical place, a deterministic id and an ISO date, as far as they have the columns; values that no rule reads stay as they are."""
    out = rows.withColumn("normalizer_version", F.lit(NORMALIZER_VERSION))
    if place in out.columns:
        found = location.normalize_location(F.col(place), synonyms or location.SYNONYMS)
        labelled = F.transform(F.array(found), lambda x: F.when(x["estado"].isNotNull(), location.location_label(x)))
        out = out.withColumn(place, F.coalesce(F.get(labelled, F.lit(0)), F.col(place)))
    if name in out.columns and place in out.columns:
        out = out.withColumn("deterministic_id", text.deterministic_id(text.phonetic_hash(text.normalize_person_name(F.col(name))), F.col(place)))
    if "date_iso" in out.columns:
        out = out.withColumn("date_iso", F.coalesce(dates.normalize_date(F.col("date_iso"))["value"], F.col("date_iso")))
    return out


def union_sources(parts: list[DataFrame]) -> DataFrame:
    """The rows of all sources; columns that one lacks are null there. Spark runs the sources side by side."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def ingest(spark: SparkSession, sources: list[dict], secret: str | None = None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Reads, parses and tokenises all enabled sources: (records, held_back, failures).

    A source whose adapter or parser is unknown, or that cannot be planned, is listed in failures and
    does not stop the others; what fails while running fails its job, which Spark repeats.
    """
    good, bad, failures = [], [], []
    for source in (s for s in sources if s.get("enabled")):
        reads, parses = adapter_for(source), parser_for(source)
        if reads is None or parses is None:
            failures.append(f"{source.get('id')}: no {'adapter' if reads is None else 'parser'}")
            continue
        try:
            parsed, broken = parses(reads(spark, source))
            kept, untreated = apply_pii(parsed, secret, "Person", "source_record_id")
        except Exception as error:  # a source that cannot be planned must not stop the others; it is reported
            failures.append(f"{source.get('id')}: {type(error).__name__}")
            continue
        good.append(kept.drop("source_id").withColumn("source_id", F.lit(source["id"])))
        bad += [x.select(F.lit(source["id"]).alias("source_id"), "body", "reason_code") for x in (broken, untreated)]
    if not good:
        return spark.createDataFrame([], "source_id string"), spark.createDataFrame([], "source_id string, body string, reason_code string"), failures
    return union_sources(good), union_sources(bad), failures
