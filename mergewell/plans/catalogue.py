"""All queries of the record operators on the given tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mergewell.functions import dates, location, pii, scores, text
from mergewell.operators import candidates, components, consolidate, gold, ingest, keys, provenance, records
from mergewell.session import spread
from mergewell.sources import config, pages
from mergewell.streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
SECRET = "fixture-secret-not-for-production"
EVENT_ID = "11111111-1111-4111-8111-111111111111"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


MATCH_SQL = "trim(regexp_replace(strip_accents(lower(coalesce({}, ''))), '[^a-z0-9]+', ' ', 'g'))"
SPACES_SQL = r"trim(regexp_replace(coalesce({}, ''), '\s+', ' ', 'g'))"


# Scalar functions.


@query(f"select doc_id, {MATCH_SQL.format('text')} as matched from documents")
def normalize_for_match(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.normalize_for_match(F.col("text")).alias("matched"))


#: Lead characters in compatibility form and what they are plainly.
FORMS = (("\uff2d\uff4f\uff52\uff41", "mora"), ("\ufb01n", "fin"), ("\u2460\u00b2", "12"), ("\u0130\u1d2c", "ia"), ("Jos\u0065\u0301", "jose"), ("\u33a1", "m2"))


@query(f"select p_partkey, {[plain for _, plain in FORMS]}[p_partkey % {len(FORMS)} + 1] || ' ' || {MATCH_SQL.format('p_name')} as matched from part")
def match_compatibility_forms(spark, sf_dir):
    lead = F.get(F.array(*[F.lit(form) for form, _ in FORMS]), (F.col("p_partkey") % len(FORMS)).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", text.normalize_for_match(F.concat_ws("  ", lead, "p_name")).alias("matched"))


@query(f"select doc_id, sha256({SPACES_SQL.format('text')}) as text_sha256 from documents")
def normalize_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(text.normalize_text(F.col("text")), 256).alias("text_sha256"))


@query(f"select doc_id, sha256({SPACES_SQL.format('nfc_normalize(text)')}) as text_sha256 from documents")
def normalize_unicode(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(text.normalize_unicode(F.col("text")), 256).alias("text_sha256"))


ABBREVIATED = "'Edo. ' || s_name || ', Av  Mun. ' || n_name || ' (C/C)'"


@query(f"select s_suppkey, replace(replace(replace(replace(replace({ABBREVIATED}, 'Edo.', 'Estado'), 'Av  ', 'Avenida '), 'Mun.', 'Municipio'), 'C/C', 'Centro Comercial'), '  ', ' ') as expanded from supplier join nation on s_nationkey = n_nationkey")
def expand_abbreviations(spark, sf_dir):
    joined = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.select("s_suppkey", text.expand_abbreviations(F.expr(ABBREVIATED)).alias("expanded"))


@query("select p_partkey, array_to_string(list_transform(string_split(p_name || ' de la CRUZ', ' '), lambda w, i: case when i > 1 and lower(w) in ('de', 'del', 'la', 'las', 'los', 'y', 'e') then lower(w) else upper(lower(w)[1]) || lower(w)[2:] end), ' ') as proper from part")
def normalize_proper_name(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.normalize_proper_name(F.concat("p_name", F.lit(" de la CRUZ"))).alias("proper"))


@query("select p_partkey, lower(p_name) as person, array_to_string(list_sort(string_split(lower(p_name), ' ')), ' ') as name_key from part")
def person_names(spark, sf_dir):
    named = F.concat(F.lit("Sr. "), F.upper("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", text.normalize_person_name(named).alias("person"), text.name_key(named).alias("name_key"))


_RUNS_SQL = "array_to_string(list_transform(list_filter(range(1, length(k) + 1), lambda i: i = 1 or k[i] <> k[i - 1]), lambda i: k[i]), '')"


def _key_sql(name: str) -> str:
    out = f"strip_accents(replace(lower(trim({name})), 'ñ', 'ni'))"
    for old, new in (("ll", "y"), ("ch", "x"), ("rr", "r"), ("h", ""), ("b", "v"), ("z", "s"), ("c", "s"), ("g", "j")):
        out = f"replace({out}, '{old}', '{new}')"
    return out


@query(f"select p_partkey, phonetic, sha256(phonetic || '|' || p_brand)[1:16] as deterministic_id from (select p_partkey, p_brand, {_RUNS_SQL} as phonetic from (select p_partkey, p_brand, {_key_sql('p_name')} as k from part))")
def spanish_phonetic_key(spark, sf_dir):
    keyed = table(spark, sf_dir, "part").withColumn("phonetic", text.spanish_phonetic_key(F.col("p_name")))
    return keyed.select("p_partkey", "phonetic", text.deterministic_id(F.col("phonetic"), F.col("p_brand")).alias("deterministic_id"))


@query()
def phonetic_hash(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.phonetic_hash(F.col("p_name")).alias("phonetic"))


def _hmac_sql(message: str) -> str:
    key = SECRET.encode().ljust(64, b"\0")
    pad = lambda x: "".join(f"\\x{b ^ x:02X}" for b in key)
    return f"sha256('{pad(0x5C)}'::blob || unhex(sha256('{pad(0x36)}'::blob || encode({message}))))"


@query(f"select c_custkey, {_hmac_sql(chr(39) + 'v' + chr(39) + ' || lpad(c_custkey::varchar, 8, ' + chr(39) + '0' + chr(39) + ')')} as token, '****' || right(lpad(c_custkey::varchar, 8, '0'), 4) as masked, lpad(c_custkey::varchar, 8, '0') as digits from customer")
def identity_tokens(spark, sf_dir):
    shown = F.concat(F.lit("V-"), F.lpad(F.col("c_custkey").cast("string"), 8, "0"))
    return table(spark, sf_dir, "customer").select("c_custkey", text.identity_token(shown, SECRET).alias("token"), text.mask_last4(shown).alias("masked"), text.digits_only(shown).alias("digits"))


@query("select event_id, strftime(ts, '%Y-%m-%d') as dmy, strftime(ts, '%Y-%m-%dT%H:%M:00') as timed, strftime(date_trunc('month', ts), '%Y-%m-%d') as month_start, strftime(last_day(ts), '%Y-%m-%d') as month_end, null::varchar as bad from events")
def normalize_date(spark, sf_dir):
    ts = F.col("ts")
    made = table(spark, sf_dir, "events").select(
        "event_id", dates.normalize_date(F.date_format(ts, "d/M/yyyy"))["value"].alias("dmy"), dates.normalize_date(F.date_format(ts, "yyyy-MM-dd HH:mm"))["value"].alias("timed"),
        dates.normalize_date(F.date_format(ts, "M/yyyy")).alias("month"), dates.normalize_date(F.concat(F.lit("31 de febrero de "), F.date_format(ts, "yyyy")))["value"].alias("bad"),
    )
    return made.select("event_id", "dmy", "timed", F.col("month.start").cast("string").alias("month_start"), F.col("month.end").cast("string").alias("month_end"), "bad")


@query("select event_id, strftime(ts, '%Y-%m-%dT%H') as hour, strftime(ts - interval 5 minute, '%Y-%m-%d %H:%M:%S') as margin from events")
def truncate_to_hour(spark, sf_dir):
    stamp = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select("event_id", dates.truncate_to_hour(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("hour"), F.date_format(dates.with_safety_margin(stamp), "yyyy-MM-dd HH:mm:ss").alias("margin"))


PLACES = ("Petare, Edo. Miranda", "Caracas", "Maracaibo, Estado Zulia", "Mun. Iribarren", "guaira", "Sucre", "nowhere")


def _place(key: Column) -> Column:
    return F.get(F.array(*[F.lit(p) for p in PLACES]), (key % len(PLACES)).cast("int"))


@query("select s_suppkey, ['Miranda', 'Distrito Capital', 'Zulia', 'Lara', 'La Guaira', 'Sucre', null][s_suppkey % 7 + 1] as estado, ['Sucre', 'Libertador', 'Maracaibo', 'Iribarren', null, null, null][s_suppkey % 7 + 1] as municipio, ['Sucre, Miranda', 'Libertador, Distrito Capital', 'Maracaibo, Zulia', 'Iribarren, Lara', 'La Guaira', 'Sucre', 'nowhere'][s_suppkey % 7 + 1] as label from supplier")
def normalize_location(spark, sf_dir):
    placed = table(spark, sf_dir, "supplier").withColumn("l", location.normalize_location(_place(F.col("s_suppkey")), normal_text=False))
    return placed.select("s_suppkey", "l.estado", "l.municipio", location.location_label(F.col("l")).alias("label"))


@query("""select p_partkey, 'x' as city, lower(p_type) as state, round(jaro_winkler_similarity(lower(p_name), lower(p_brand || ' ' || p_type)), 6) as similarity from part""")
def name_similarity(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    place = location.city_and_state(F.concat(F.lit("X, "), F.col("p_type")))
    both = part.select("p_partkey", place.alias("p"), F.lower("p_name").alias("a"), F.lower(F.concat_ws(" ", "p_brand", "p_type")).alias("b"))
    return both.select("p_partkey", "p.city", "p.state", F.round(scores.jaro_winkler_udf("a", "b"), 6).alias("similarity"))


TIER = "['A', 'B', 'C', 'D', 'x'][n_regionkey + 1]"


@query(f"select s_suppkey, round(least(1.0, 0.25 + 0.25 + case when s_acctbal > 0 then 0.2 else 0 end + case {TIER} when 'A' then 0.2 when 'B' then 0.15 when 'C' then 0.1 else 0.05 end), 3) as confidence, case {TIER} when 'A' then 1 when 'B' then 2 when 'C' then 3 when 'D' then 4 else 5 end as tier_rank, case {TIER} when 'A' then 4 when 'B' then 3 when 'C' then 2 else 1 end as trust_rank, case {TIER} when 'A' then 0.9 when 'B' then 0.75 when 'C' then 0.6 when 'D' then 0.35 else 0.1 end as tier_confidence from supplier join nation on s_nationkey = n_nationkey")
def confidence_scores(spark, sf_dir):
    joined = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    centers = joined.select("s_suppkey", F.col("s_name").alias("name"), F.col("n_name").alias("location_text"), F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("coordinates"), F.lit("").alias("needs"), F.get(F.array(*[F.lit(t) for t in "ABCDx"]), F.col("n_regionkey")).alias("trust_tier"))
    scored = records.score_entity(centers, "AcopioCenter")
    t = F.col("trust_tier")
    return scored.select("s_suppkey", F.col("confidence_score").alias("confidence"), scores.tier_rank(t).alias("tier_rank"), scores.trust_rank(t).alias("trust_rank"), scores.confidence_from_tier(t).alias("tier_confidence"))


@query("select c_custkey, case when age between 0 and 130 then age end as age_min, case when age between 0 and 130 then age < 18 end as minor from (select c_custkey, (c_custkey % 160)::int as age from customer)")
def age_ranges(spark, sf_dir):
    ages = table(spark, sf_dir, "customer").withColumn("a", scores.age_range((F.col("c_custkey") % 160).cast("string")))
    return ages.select("c_custkey", F.col("a.min").alias("age_min"), scores.is_minor(F.col("a")).alias("minor"))


# Personal data.


def _bounded(kind: str) -> str:
    """The pattern with word borders that know letters beyond ASCII, as group 1 and, behind words for minors, group 2."""
    pattern = pii.PATTERNS[kind]
    if kind != "phone":
        pattern = r"(^|[^\p{L}\p{N}_])" + pattern.removeprefix(r"\b")
    return pattern.removesuffix(r"\b") + r"($|[^\p{L}\p{N}_])" if kind == "possible_minor" else pattern


def _found_sql(kind: str) -> str:
    return f"regexp_extract_all(coalesce(text, ''), '(?i){_bounded(kind)}')"


@query("select doc_id, " + ", ".join(f"len({_found_sql(k)}) as {k}" for k in pii.PATTERNS) + " from documents")
def pii_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", *[pii.pii_count(F.col("text"), k).alias(k) for k in pii.PATTERNS])


@query(" union all ".join(f"select doc_id, '{k}' as kind, len({_found_sql(k)}) as n from documents where len({_found_sql(k)}) > 0" for k in pii.PATTERNS))
def detect_pii(spark, sf_dir):
    found = table(spark, sf_dir, "documents").where(pii.has_pii(F.col("text"))).select("doc_id", F.explode(pii.detect_pii("text")).alias("f"))
    return found.groupBy("doc_id", "f.kind").agg(F.count("*").alias("n"))


def _redacted_sql() -> str:
    """Replacement kind by kind; equal to merged spans where findings of two kinds don't overlap."""
    out = "text"
    for kind in pii.PATTERNS:
        before, after = "" if kind == "phone" else r"\1", r"\2" if kind == "possible_minor" else ""
        out = f"regexp_replace({out}, '(?i){_bounded(kind)}', '{before}[REDACTED_{kind.upper()}]{after}', 'g')"
    return out


@query(f"select doc_id, sha256({_redacted_sql()}) as redacted_sha256 from documents")
def redact_pii(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(pii.redact_pii(F.col("text")), 256).alias("redacted_sha256"))


@query(f"select c_custkey, 'x [REDACTED_IDENTITY_DOCUMENT_' || {_hmac_sql(chr(39) + 'cedula' + chr(39) + ' || lpad(c_custkey::varchar, 8, ' + chr(39) + '0' + chr(39) + ')')} || ']' as redacted from customer")
def redact_with_tokens(spark, sf_dir):
    said = F.concat(F.lit("x CÉDULA: "), F.lpad(F.col("c_custkey").cast("string"), 8, "0"))
    return table(spark, sf_dir, "customer").select("c_custkey", pii.redact_pii(said, SECRET).alias("redacted"))


@query(r"""select c_custkey, case when k = 2 then 'pii_untreatable' else 'kept' end as outcome, case when k = 0 then 'hmac_sha256:' || """ + _hmac_sql("lpad(c_custkey::varchar, 8, '0')") + r""" end as token, case when k = 0 then '****' || right(lpad(c_custkey::varchar, 8, '0'), 4) end as masked from (select c_custkey, c_custkey % 4 as k from customer)""")
def apply_pii(spark, sf_dir):
    """Identifiers that can be tokenised, that cannot (with and without a name) and that are missing."""
    k = F.col("c_custkey") % 4
    given = F.when(k == 0, F.lpad(F.col("c_custkey").cast("string"), 8, "0")).when(k < 3, "\u2014\u2014")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.when(k != 2, F.col("c_name")).alias("full_name"), given.alias("cedula"))
    good, bad = ingest.apply_pii(rows, SECRET, "Person", "c_custkey")
    kept = good.select("c_custkey", F.lit("kept").alias("outcome"), F.when(k == 0, F.col("cedula_hmac")).alias("token"), F.col("cedula_masked").alias("masked"))
    none = F.lit(None).cast("string")
    return kept.unionByName(bad.select(F.get_json_object("body", "$.c_custkey").cast("long").alias("c_custkey"), F.col("reason_code").alias("outcome"), none.alias("token"), none.alias("masked")))


@query(r"select doc_id, regexp_matches(text, '(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b') as quarantined from documents")
def unmapped_gate(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.struct(F.regexp_replace(F.regexp_extract("text", "(?iuU)" + pii.PATTERNS["email"], 0), r"\.\.+", ".").alias("extra")).alias("unmapped"))
    clean, dirty = records.gate_unmapped(rows)
    return clean.select("doc_id", F.lit(False).alias("quarantined")).unionByName(dirty.select("doc_id", F.lit(True).alias("quarantined")))


_SUMMARY_SQL = "'{' || array_to_string(list_filter([" + ", ".join(f"case when len({_found_sql(k)}) > 0 then '\"{k}\":' || len({_found_sql(k)}) end" for k in pii.PATTERNS) + "], lambda x: x is not null), ',') || '}'"


@query(f"select source as source_slug, 'pii_untreatable' as reason_code, 'high' as risk_level, sha256(text) as payload_hash, substring({_redacted_sql()}, 1, 500) as payload_preview_redacted, {_SUMMARY_SQL} as pii_findings_summary, 'pending' as review_status from documents where " + " or ".join(f"len({_found_sql(k)}) > 0" for k in pii.PATTERNS))
def quarantine(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").where(pii.has_pii(F.col("text"))).select(F.col("source").alias("source_slug"), "text")
    made = provenance.quarantine_sink(records.quarantine_rows(rows, "text", "pii_untreatable", "high"), F.lit("run"), F.lit("2024-01-10").cast("timestamp"))
    return made.select("source_slug", "reason_code", "risk_level", "payload_hash", "payload_preview_redacted", F.to_json("pii_findings_summary").alias("pii_findings_summary"), "review_status")


# Fingerprints and exact consolidation.


@query(rf"select event_id, sha256({MATCH_SQL.format('event_type')} || '|' || {MATCH_SQL.format(chr(39) + 'user ' + chr(39) + ' || user_id')} || '|' || strftime(ts, '%Y-%m-%dT%H')) as fingerprint from events")
def event_fingerprint(spark, sf_dir):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, sf_dir, "events").select("event_id", keys.event_fingerprint(F.col("event_type"), F.concat(F.lit("user "), F.col("user_id")), iso).alias("fingerprint"))


@query(f"select s_suppkey, sha256('{EVENT_ID.replace('-', ' ')}' || '|' || {MATCH_SQL.format('s_name')} || '|' || {MATCH_SQL.format('n_name')}) as fingerprint from supplier join nation on s_nationkey = n_nationkey")
def center_fingerprint(spark, sf_dir):
    joined = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.select("s_suppkey", keys.center_fingerprint(F.lit(EVENT_ID), F.col("s_name"), F.col("n_name")).alias("fingerprint"))


def event_records(spark, sf_dir) -> DataFrame:
    ts = F.date_trunc("second", F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("id"), F.concat_ws("|", "event_type", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("dedup_hash"),
        F.get(F.array(*[F.lit(t) for t in "ABCD"]), (F.col("user_id") % 4).cast("int")).alias("trust_tier"), F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("fetched_at"),
        F.col("value").alias("confidence_score"), ts.alias("created_at"), F.concat(F.lit("s"), (F.col("event_id") % 3).cast("string")).alias("source_id"), "event_type",
    )


EVENT_RECORDS_SQL = "select lpad(event_id::varchar, 12, '0') as id, event_type || '|' || user_id || '|' || strftime(ts, '%Y-%m-%d') as dedup_hash, ['A','B','C','D'][user_id % 4 + 1] as trust_tier, strftime(ts, '%Y-%m-%d %H:%M:%S') as fetched_at, value as confidence_score, date_trunc('second', ts) as created_at, 's' || (event_id % 3) as source_id, event_type from events"


@query(f"select dedup_hash, id as winner_id, group_size from (select *, count(*) over (partition by dedup_hash) as group_size, row_number() over (partition by dedup_hash order by trust_tier, fetched_at desc, confidence_score desc, created_at, source_id, id) as n from ({EVENT_RECORDS_SQL})) where n = 1")
def pick_winner(spark, sf_dir):
    return consolidate.pick_winners(event_records(spark, sf_dir)).select("dedup_hash", F.col("id").alias("winner_id"), "group_size")


@query(f"select dedup_hash, 1 as dedup_version, id as winner_id, event_type from (select *, row_number() over (partition by dedup_hash order by trust_tier, fetched_at desc, confidence_score desc, created_at, source_id, id) as n from ({EVENT_RECORDS_SQL})) where n = 1")
def canonical_records(spark, sf_dir):
    return consolidate.canonical_records(consolidate.pick_winners(event_records(spark, sf_dir)), "Event")


@query("select h as fingerprint, arg_max(doc_id, (tier, -doc_id)) as doc_id, min(doc_id) as first_pos from (select sha256(text) as h, doc_id, case when quality = 1 then 4 else 1 end as tier from documents left join labels using (doc_id)) group by h")
def deduplicate_typed(spark, sf_dir):
    joined = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    entities = joined.select(F.sha2("text", 256).alias("fingerprint"), "doc_id", F.when(F.col("quality") == 1, "A").otherwise("D").alias("trust_tier"), F.col("doc_id").alias("pos"))
    return consolidate.deduplicate_typed(entities).select("fingerprint", "doc_id", "first_pos")


@query("select min(doc_id) as doc_id from documents where sha256(text) not in (select sha256(text) from documents where doc_id < 100) group by text")
def first_seen(spark, sf_dir):
    items = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("fingerprint"), F.col("doc_id").alias("pos"))
    return consolidate.first_seen(items, items.where("doc_id < 100")).select("doc_id")


@query("select o_orderkey, case when o_orderkey % 2 = 0 then 'new3' else o_orderstatus end as status from orders union all select 10000000 + o_orderkey, 'new3' from orders where o_orderkey % 5 = 0")
def staging_upsert(spark, sf_dir):
    """Every key arrives three times; the last version wins."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    arrived = orders.where("o_orderkey % 2 = 0").select("o_orderkey").unionByName(orders.where("o_orderkey % 5 = 0").select((F.col("o_orderkey") + 10000000).alias("o_orderkey")))
    new = arrived.withColumn("version", F.explode(F.array(F.lit(2), F.lit(3), F.lit(1)))).withColumn("status", F.concat(F.lit("new"), F.col("version")))
    return consolidate.upsert(orders, new, ["o_orderkey"], order="version")


@query("select distinct o_custkey from orders where o_custkey not in (select c_custkey from customer where c_custkey % 3 = 0)")
def insert_ignore(spark, sf_dir):
    current = table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("o_custkey"))
    return consolidate.insert_ignore(current, table(spark, sf_dir, "orders").select("o_custkey"), ["o_custkey"])


@query("select event_id as id from events where (ts, event_id) > (timestamp '2024-01-05 00:00:00', 100) order by ts, event_id limit 500")
def keyset_page(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("created_at"), F.col("event_id").alias("id"))
    return consolidate.keyset_page(rows, 500, ("2024-01-05 00:00:00", 100)).select("id")


@query("select doc_id from (select doc_id, row_number() over (partition by source order by doc_id) as n from documents) where n <= 10")
def limit_per_source(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "source")
    return consolidate.limit_per_source(rows, 10, "source", ("doc_id",)).select("doc_id")


@query("select c_custkey as id, 'p' as origin from customer where c_custkey % 2 = 0 union all select c_custkey, 'e' from customer where c_custkey % 3 = 0 and c_custkey % 2 <> 0")
def union_by_id(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    pick = lambda n, o: c.where(F.col("c_custkey") % n == 0).select(F.col("c_custkey").alias("id"), F.lit(o).alias("origin"))
    return consolidate.union_by_id(pick(2, "p"), pick(3, "e"))


@query("select json_keys(props)[1] as signature, count(*) as rows from events group by 1")
def key_signatures(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.from_json("props", "map<string,string>").alias("m"))
    return consolidate.group_by_signature(rows, "m")


@query("select s_suppkey, sha256('acopiocenter|src|' || s_suppkey) as external_id, sha256('{\"name\":\"' || s_name || '\",\"nota\":null}') as content_hash from supplier")
def staging_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("name"), F.lit(None).cast("string").alias("nota"), F.lit("x").alias("_meta"))
    made = records.staging_rows(rows.withColumn("key", F.col("s_suppkey")), "AcopioCenter", F.lit("src"), "key", ["name", "nota", "_meta"])
    return made.withColumn("s_suppkey", F.get_json_object("raw_json", "$.name").substr(10, 9).cast("long")).select("s_suppkey", "external_id", "content_hash")


# Blocks, pairs, edges, clusters.


def persons(spark, sf_dir) -> DataFrame:
    """Parts as persons: brand and size are the identifier of every third, type the state, size the age."""
    p = table(spark, sf_dir, "part")
    made = p.select(
        F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("id"), F.col("p_name").alias("full_name"), F.lit("ev").alias("event_id"),
        F.when(F.col("p_partkey") % 3 == 0, F.sha2(F.concat_ws("|", "p_brand", "p_size"), 256)).alias("cedula_hmac"),
        F.when(F.col("p_partkey") % 3 == 1, "partial").otherwise("none").alias("identity_kind"), F.when(F.col("p_partkey") % 3 == 1, F.lpad(F.col("p_size").cast("string"), 4, "0")).alias("cedula_partial"),
        F.when(F.col("p_partkey") % 3 == 1, "suffix_4").alias("cedula_partial_pattern"), F.concat(F.lit("C, "), F.col("p_type")).alias("last_known_location"),
        F.struct(F.col("p_size").alias("min"), (F.col("p_size") + 10).alias("max")).alias("age_range"), F.lit("missing").alias("status"),
    )
    key = keys.person_block_keys(F.col("event_id"), F.col("full_name"), F.col("cedula_hmac"), F.col("identity_kind"), F.col("cedula_partial"), F.col("cedula_partial_pattern"), text.spanish_phonetic_key(F.col("full_name")))
    return made.withColumn("block_keys", key)


PERSONS_SQL = f"""p as (select lpad(p_partkey::varchar, 9, '0') as id, lower(p_name) as name, p_partkey % 3 as kind, sha256(p_brand || '|' || p_size) as hmac, lpad(p_size::varchar, 4, '0') as digits, p_type, p_size, {_RUNS_SQL} as ph
  from (select *, {_key_sql('p_name')} as k from part)),
m as (select id, 'phon:ev:' || ph as block_key from p union all select id, 'ced:ev:' || hmac from p where kind = 0 union all select id, 'ced_partial:ev:suffix_4:' || digits from p where kind = 1)"""
EDGES_SQL = f"""with {PERSONS_SQL},
pairs as (select a.id as left_id, b.id as right_id, block_key as blocking_key from m a join m b using (block_key) where a.id < b.id),
s as (select pairs.*, a.kind = 0 and b.kind = 0 and a.hmac <> b.hmac as veto,
  0.4 * jaro_winkler_similarity(a.name, b.name) + 0.3 * (case when a.kind = 0 and b.kind = 0 and a.hmac = b.hmac then 1.0 when a.kind = 1 and b.kind = 1 and a.digits = b.digits then 0.5 else 0 end)
  + case when a.p_type = b.p_type then 0.15 else 0 end + 0.05
  + 0.1 * case when abs(a.p_size - b.p_size) < 10 then (10 - abs(a.p_size - b.p_size)) / (10 + abs(a.p_size - b.p_size)) else 0 end as score
  from pairs join p a on a.id = left_id join p b on b.id = right_id)
"""


@query(f"with {PERSONS_SQL} select block_key, count(*) as members, (count(*) * (count(*) - 1) // 2)::bigint as pairs from m group by block_key")
def block_stats(spark, sf_dir):
    return candidates.block_stats(candidates.blocks(persons(spark, sf_dir)))


@query(EDGES_SQL + "select left_id, right_id, blocking_key, round(score, 3) as score, case when round(score, 4) >= 0.95 then 2 else 1 end as priority from s where not veto and round(score, 4) >= 0.85")
def candidate_edges(spark, sf_dir):
    found = candidates.find_candidates(persons(spark, sf_dir), exact=True)
    return found.select("left_id", "right_id", "blocking_key", F.round("exact", 3).alias("score"), "priority")


@query(EDGES_SQL + "select left_id, right_id, blocking_key from s where not veto and round(score, 4) >= 0.85 and (right(left_id, 2) = '07' or right(right_id, 2) = '07')")
def candidate_edges_of_new(spark, sf_dir):
    people = persons(spark, sf_dir)
    return candidates.find_candidates(people, new_ids=people.where("right(id, 2) = '07'").select("id")).select("left_id", "right_id", "blocking_key")


@query(f"with {PERSONS_SQL} select distinct id from m where right(id, 1) <> '0' and block_key in (select block_key from m where right(id, 1) = '0')")
def block_partners(spark, sf_dir):
    people = persons(spark, sf_dir)
    new, old = people.where("right(id, 1) = '0'"), people.where("right(id, 1) <> '0'")
    return candidates.partners(candidates.blocks(new), old).select("id")


@query(EDGES_SQL + "select left_id, right_id, case when left_id[9] = '3' then 'rejected' else 'pending' end as decision from s where not veto and round(score, 4) >= 0.85")
def merge_edges(spark, sf_dir):
    found = candidates.find_candidates(persons(spark, sf_dir))
    old = found.where("right(left_id, 1) = '3'").select(F.col("right_id").alias("left_id"), F.col("left_id").alias("right_id"), "blocking_key", F.lit(0.5).alias("score"), "reasons", F.lit(1).alias("priority"), F.lit("rejected").alias("decision"))
    merged = candidates.merge_candidates(old, found)
    return merged.select(F.least("left_id", "right_id").alias("left_id"), F.greatest("left_id", "right_id").alias("right_id"), "decision")


@query("select o_orderkey::varchar as left_id, case when o_orderkey % 7 = 0 then 'lacking' else 'pending' end as decision, case when o_orderkey % 7 <> 0 then o_custkey % 2 = 0 end as touches_gold, case when o_orderkey % 7 <> 0 then case when o_orderkey % 3 = 0 then 1 else 2 end end as priority from orders")
def edge_rows(spark, sf_dir):
    k = F.col("o_orderkey")
    found = table(spark, sf_dir, "orders").select(k.cast("string").alias("left_id"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("right_id"), F.lit("b").alias("blocking_key"), F.when(k % 7 == 0, 0.0).otherwise(0.9).alias("score"), F.when(k % 3 == 0, 1).alias("priority"))
    stored, lacking = candidates.edge_rows(found)
    gold_ids = table(spark, sf_dir, "orders").where("o_custkey % 2 = 0").select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("id"))
    marked = candidates.mark_gold(stored, gold_ids).select("left_id", "decision", "touches_gold", "priority")
    none = lacking.select("left_id", F.lit("lacking").alias("decision"), F.lit(None).cast("boolean").alias("touches_gold"), F.lit(None).cast("int").alias("priority"))
    return marked.unionByName(none)


@query("select n_nationkey as node, min(n_nationkey) over (partition by n_regionkey) as component from nation")
def connected_components(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    ordered = n.select("n_nationkey", F.expr("lead(n_nationkey) over (partition by n_regionkey order by n_nationkey)").alias("next")).where("next is not null")
    return components.connected_components(ordered, "n_nationkey", "next")


def _clusters(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    people = persons(spark, sf_dir)
    found = candidates.find_candidates(people).withColumn("decision", F.lit("pending"))
    rows = people.select("id", F.lit("A").alias("trust_tier"), F.lit(None).cast("string").alias("fetched_at"), F.lit(0.5).alias("confidence_score"), F.lit("2024-01-01").alias("created_at"), F.lit("s").alias("source_id"))
    return (rows, *gold.gold_tables(rows, gold.clusters(found)))


@query(EDGES_SQL + """, e as (select left_id as a, right_id as b from s where not veto and round(score, 4) >= 0.85 and blocking_key like 'ced:%'),
r as (with recursive x(a, b) as (select a, b from (select a, b from e union select b, a from e union select a, a from e union select b, b from e) union select x.a, y.b from x join (select a, b from e union select b, a from e) y on x.b = y.a) select a, min(b) as c from x group by a)
select c as gold_id, min(a) as winner_id, count(*) as members from r group by c""")
def gold_entities(spark, sf_dir):
    return _clusters(spark, sf_dir)[1]


@query(EDGES_SQL + """, e as (select left_id as a, right_id as b from s where not veto and round(score, 4) >= 0.85 and blocking_key like 'ced:%'),
r as (with recursive x(a, b) as (select a, b from (select a, b from e union select b, a from e union select a, a from e union select b, b from e) union select x.a, y.b from x join (select a, b from e union select b, a from e) y on x.b = y.a) select a, min(b) as c from x group by a)
select p.id, r.c as gold_id from p left join r on p.id = r.a where r.c is null or r.c = p.id""")
def published(spark, sf_dir):
    rows, entities, members, _ = _clusters(spark, sf_dir)
    return gold.published(rows, entities, members).select("id", "gold_id")


@query(EDGES_SQL + """, e as (select left_id as a, right_id as b from s where not veto and round(score, 4) >= 0.85 and blocking_key like 'ced:%'),
r as (with recursive x(a, b) as (select a, b from (select a, b from e union select b, a from e union select a, a from e union select b, b from e) union select x.a, y.b from x join (select a, b from e union select b, a from e) y on x.b = y.a) select a, min(b) as c from x group by a)
select c as gold_id, a as id, case when count(*) over (partition by c) > 1 then 'merge' else 'passthrough' end as action from r""")
def gold_members(spark, sf_dir):
    _, _, members, history = _clusters(spark, sf_dir)
    return members.join(history.select("gold_id", "action"), "gold_id")


# Rules, minors, projection.


@query("select c_custkey, foto, masked, place, place_status from (select c_custkey, case when minor then null else 'f' end as foto, case when minor then null else '****1234' end as masked, case when not minor then p when p like '%,%,%' then null when p like '%,%' then trim(split_part(p, ',', 2)) else p end as place, case when not minor then null when p like '%,%' then 'removed_minor' else 'present' end as place_status from (select c_custkey, c_custkey % 2 = 0 as minor, ['Chacao, Miranda', 'Zulia', 'a, b, c'][c_custkey % 3 + 1] as p from customer))")
def protect_minors(spark, sf_dir):
    place = F.get(F.array(F.lit("Chacao, Miranda"), F.lit("Zulia"), F.lit("a, b, c")), (F.col("c_custkey") % 3).cast("int"))
    none = F.lit(None).cast("string")
    rows = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 2 == 0).alias("is_minor"), F.lit("f").alias("foto"), none.alias("foto_status"), F.lit("****1234").alias("cedula_masked"), place.alias("last_known_location"), none.alias("last_known_location_status"))
    return records.protect_minors(rows).select("c_custkey", "foto", F.col("cedula_masked").alias("masked"), F.col("last_known_location").alias("place"), F.col("last_known_location_status").alias("place_status"))


@query("select s_suppkey, case when s_suppkey % 4 = 0 then 'coordinates' when s_suppkey % 4 = 1 then 'status' when s_suppkey % 4 = 2 then 'name' else '' end as broken from supplier")
def validate_centers(spark, sf_dir):
    k = F.col("s_suppkey") % 4
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.when(k == 2, " ").otherwise(F.col("s_name")).alias("name"), F.lit("x").alias("location_text"), F.lit("f").alias("fuente"), F.lit(EVENT_ID).alias("event_id"), F.when(k == 1, "odd").otherwise("active").alias("status"), F.lit("a").alias("trust_tier"), F.struct(F.when(k == 0, 91.0).otherwise(10.0).alias("lat"), F.lit(-66.0).alias("lon")).alias("coordinates"))
    return rows.select("s_suppkey", F.array_join(records.broken_center_rules(), ",").alias("broken"))


@query("select c_custkey as id, case when c_custkey % 5 = 0 then 'E0' else 'E1' end as event_id, c_name as full_name, case when c_custkey % 3 < 2 then 'missing' else 'deceased' end as status from customer")
def materialize(spark, sf_dir):
    k = F.col("c_custkey")
    raw = F.to_json(F.struct(F.col("c_name").alias("full_name"), F.when(k % 5 == 0, F.lit("")).otherwise(F.lit("E1")).alias("event_id"), F.get(F.array(F.lit("found"), F.lit("missing"), F.lit("deceased")), (k % 3).cast("int")).alias("status"), F.lit("x").alias("_meta")))
    rows = table(spark, sf_dir, "customer").select(k.alias("id"), raw.alias("raw_json"))
    return records.project(rows, records.PERSON_FIELDS, "struct<full_name:string,event_id:string,status:string>", "E0")


@query("select event_id, case when ts < timestamp '2024-01-10 00:00:00' - interval 12 hour then null else event_type end as raw_text, case when ts < timestamp '2024-01-10 00:00:00' - interval 12 hour then 'purged' else 'raw' end as pii_status from events")
def retention(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("fetched_at"), F.col("event_type").alias("raw_text"), F.lit("raw").alias("pii_status"))
    return records.purge_raw_text(rows, F.lit("2024-01-10 00:00:00").cast("timestamp")).drop("fetched_at")


@query(r"select page_id, lower(regexp_extract(url, '://([^/:?#]*)', 1)) like '%.example.com' and split_part(lower(regexp_extract(url, '://([^/:?#]*)', 1)), '.', 1) = 'www' as allowed from pages")
def allowed_domains(spark, sf_dir):
    host = F.lower(F.regexp_extract("url", "://([^/:?#]*)", 1))
    return table(spark, sf_dir, "pages").select("page_id", (host.endswith(".example.com") & (F.substring_index(host, ".", 1) == "www")).alias("allowed"))


STAGED_SQL = "(select c_custkey as id, ['person', 'acopio_center', 'event', 'other', 'person'][c_custkey % 5 + 1] as entity_type, c_custkey % 5 = 4 as malformed, 'E' || c_custkey % 3 as event_id, c_name from customer)"


def _staged(spark, sf_dir) -> DataFrame:
    k = F.col("c_custkey")
    raw = F.to_json(F.struct(F.col("c_name").alias("full_name"), F.col("c_name").alias("name"), F.concat(F.lit("E"), (k % 3).cast("string")).alias("event_id"), F.lit("found").alias("status")))
    kind = F.get(F.array(*[F.lit(t) for t in ("person", "acopio_center", "event", "other", "person")]), (k % 5).cast("int"))
    return table(spark, sf_dir, "customer").select(k.alias("id"), kind.alias("entity_type"), F.when(k % 5 == 4, "[1]").otherwise(raw).alias("raw_json"))


@query(f"select id, case when malformed then 'malformed' when entity_type = 'other' then 'unknown' else entity_type end as target, case when not malformed and entity_type in ('person', 'acopio_center') then c_name end as name, case when not malformed and entity_type = 'person' then 'missing' when not malformed and entity_type = 'acopio_center' then 'missing' end as status from {STAGED_SQL} where entity_type <> 'event'")
def project_types(spark, sf_dir):
    people, centers, errors = records.project_types(_staged(spark, sf_dir), "E0")
    none = F.lit(None).cast("string")
    sides = [people.select("id", F.lit("person").alias("target"), F.col("full_name").alias("name"), "status"), centers.select("id", F.lit("acopio_center").alias("target"), "name", "status"), errors.select("id", F.col("reason").alias("target"), none.alias("name"), none.alias("status"))]
    return ingest.union_sources(sides)


@query(f"select distinct event_id, 'earthquake' as event_type, 'd' as description from {STAGED_SQL} where not malformed and entity_type in ('person', 'acopio_center') and event_id <> 'E1' union select 'E9', 'earthquake', 'd'")
def seed_events(spark, sf_dir):
    known = spark.range(1).select(F.lit("E1").alias("event_id"))
    return records.seed_events(_staged(spark, sf_dir), known, "E9", description="d")


@query(f"select id, ['Person', 'AcopioCenter', 'Event', 'other', 'Person'][id % 5 + 1] as entity_type, '' as trust_tier, case when malformed then '[1]' else c_name end as payload_name from {STAGED_SQL}")
def job_records(spark, sf_dir):
    rows = records.job_records(_staged(spark, sf_dir).withColumn("trust_tier", F.lit(None).cast("string")))
    return rows.select("id", "entity_type", "trust_tier", F.coalesce(F.get_json_object("payload", "$.full_name"), "payload").alias("payload_name"))


@query("""select c_custkey, ['Libertador, Distrito Capital', 'Maracaibo, Zulia', 'nowhere'][c_custkey % 3 + 1] as last_known_location, ['2024-03-05', '3 lunes', null][c_custkey % 3 + 1] as date_iso, '1' as normalizer_version from customer""")
def enrich_records(spark, sf_dir):
    pick = lambda *v: F.get(F.array(*[F.lit(x) for x in v]), (F.col("c_custkey") % 3).cast("int"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("full_name"), pick("Caracas", "Maracaibo, Estado Zulia", "nowhere").alias("last_known_location"), pick("5/3/2024", "3 lunes", None).alias("date_iso"))
    return ingest.enrich_records(rows).select("c_custkey", "last_known_location", "date_iso", "normalizer_version")


@query("select s_suppkey, sha256('acopiocenter|src|' || s_suppkey) as external_id, sha256(lower(s_name)) as dedup_hash, ['k:' || s_suppkey] as block_keys, 1 as dedup_version, '1' as normalizer_version, 'a' as artifact_id from supplier")
def staging_envelope(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("name"))
    made = records.staging_envelope(rows, "AcopioCenter", F.lit("src"), "s_suppkey", ["s_suppkey", "name"], F.sha2(F.lower("name"), 256), F.array(F.concat(F.lit("k:"), F.col("s_suppkey").cast("string"))), artifact=F.lit("a"))
    return made.select(F.get_json_object("raw_json", "$.s_suppkey").cast("long").alias("s_suppkey"), "external_id", "dedup_hash", "block_keys", "dedup_version", "normalizer_version", "artifact_id")


# Provenance and runs.

_HOST_SQL = r"regexp_extract(url, '://([^/?#]*)', 1)"


def _runs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    raw = table(spark, sf_dir, "pages").select(F.regexp_extract("url", "://([^/?#]*)", 1).alias("source_id"), F.col("url").alias("source_url"), F.col("page_id").cast("int").alias("page"), F.col("html").alias("raw_content"))
    runs = provenance.start_runs(raw.where("source_id <> ''"), "b1", F.lit("2024-01-10").cast("timestamp"))
    return raw, runs


@query(f"select sha256(run_id || '|' || coalesce(url, '') || '|' || page_id || '|' || coalesce(sha256(html), ''))[1:32] as artifact_id, run_id, source_id, page_id::int as page, sha256(html) as body_hash, 'raw' as pii_status from (select *, {_HOST_SQL} as source_id, sha256('b1|' || {_HOST_SQL})[1:32] as run_id from pages) where source_id <> ''")
def raw_artifacts(spark, sf_dir):
    raw, runs = _runs(spark, sf_dir)
    return provenance.raw_artifacts(raw, runs).select("artifact_id", "run_id", "source_id", "page", "body_hash", "pii_status")


@query("select source as source_id, count(*) as records, count(*) filter (where q = 1) as staged, count(*) filter (where q = 0) as quarantined, count(*) filter (where q is null) as failed from (select source, quality as q from documents left join labels using (doc_id)) group by rollup (source)")
def run_summary(spark, sf_dir):
    joined = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("source_id")).join(table(spark, sf_dir, "labels"), "doc_id", "left")
    outcome = F.when(F.col("quality") == 1, "staged").when(F.col("quality") == 0, "quarantined").otherwise("failed")
    return provenance.run_summary(joined.select("source_id", outcome.alias("outcome")))


@query(f"select source_id, sum(n)::bigint as pages, max(n) filter (where k = 'odd') as odd from (select {_HOST_SQL} as source_id, case when page_id % 2 = 1 then 'odd' else 'even' end as k, count(*) as n from pages where {_HOST_SQL} <> '' group by all) group by source_id")
def finish_runs(spark, sf_dir):
    raw, runs = _runs(spark, sf_dir)
    outcomes = raw.select("source_id", F.when(F.col("page") % 2 == 1, "odd").otherwise("even").alias("outcome"))
    done = provenance.finish_runs(runs, outcomes, F.lit("2024-01-11").cast("timestamp"))
    return done.select("source_id", F.aggregate(F.map_values("stats"), F.lit(0).cast("long"), lambda a, b: a + b).alias("pages"), F.try_element_at("stats", F.lit("odd")).alias("odd"))


@query("select c_custkey::varchar as source_id, case when c_custkey % 4 = 0 then 'invalid_schema' else 'parsed' end as outcome, case when c_custkey % 4 <> 0 then c_name end as name from customer")
def parse_pages(spark, sf_dir):
    body = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit('{"name": '), F.col("c_name"))).otherwise(F.to_json(F.struct(F.col("c_name").alias("name"))))
    raw = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("source_id"), body.alias("raw_content"))
    good, bad = ingest.parse_typed(raw, "struct<name:string>")
    return ingest.union_sources([good.select("source_id", F.lit("parsed").alias("outcome"), "name"), bad.select("source_id", F.col("reason_code").alias("outcome"))])


@query("select 's' || n_nationkey as id, 'http://' || lower(n_name) || '.invalid' as url, n_regionkey <> 0 and n_nationkey % 2 = 0 as enabled from nation")
def resolve_sources(spark, sf_dir):
    named = table(spark, sf_dir, "nation").withColumn("id", F.concat(F.lit("s"), F.col("n_nationkey").cast("string")))
    thin = named.select("id", F.lit("p").alias("parser_asignado"), (F.col("n_nationkey") % 2 == 0).alias("enabled"))
    listed = named.select(F.col("id").alias("source_id"), F.concat(F.lit("http://"), F.lower("n_name"), F.lit(".invalid")).alias("url"), (F.col("n_regionkey") != 0).alias("active"))
    return config.resolve_sources(thin, listed).select("id", "url", "enabled")


@query("select s_suppkey, 'host' || s_suppkey || '.invalid:8080' as web, 'dump.' || s_suppkey as file from supplier")
def source_keys(spark, sf_dir):
    k = F.col("s_suppkey").cast("string")
    return table(spark, sf_dir, "supplier").select("s_suppkey", ingest.source_key(F.concat(F.lit("HTTP://Host"), k, F.lit(".invalid:8080/a?b"))).alias("web"), ingest.source_key(F.concat(F.lit("data/dump."), k, F.lit(".txt"))).alias("file"))


# Sources.


@query()
def html_text(spark, sf_dir):
    return pages.html_pages(table(spark, sf_dir, "pages")).select("page_id", "html_title", F.sha2("body_text", 256).alias("text_sha256"))


@query("select event_id, 'k: ' || json_extract_string(props, '$.k') as lines from events")
def json_lines(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", pages.json_lines("props").alias("lines"))


#: Posts with the status and name that they tell.
POSTS = (
    ("Se busca a Ana Lopez tras el sismo", "missing", "Ana Lopez Tras El Sismo"), ("Luis Mora fallecido.", "deceased", "Luis Mora"), ("Nadie ha sido localizado.", "missing", None), ("hola", None, None),
    ("Se busca a ANA LOPEZ por", "missing", "Ana Lopez"), ("desaparecida Ana de los Rios Mora en", "missing", "Ana de los Rios Mora"), ("desaparecida Ana y Luis Mora en", "missing", None), ("encontrado Juan-Jose D'Elia con tlf", "missing", "Juan-jose D'elia"), ("Se busca a Eva en", "missing", None),
)


def _listed(column: int) -> str:
    return "[" + ", ".join("null" if p[column] is None else "'" + p[column].replace("'", "''") + "'" for p in POSTS) + "]"


@query(f"select c_custkey, {_listed(1)}[c_custkey % {len(POSTS)} + 1] as status, {_listed(2)}[c_custkey % {len(POSTS)} + 1] as full_name from customer")
def parse_posts(spark, sf_dir):
    said = F.get(F.array(*[F.lit(p[0]) for p in POSTS]), (F.col("c_custkey") % len(POSTS)).cast("int"))
    return pages.posts(table(spark, sf_dir, "customer").select("c_custkey", said.alias("text"))).select("c_custkey", "status", "full_name")


@query("select c_name as full_name, (c_custkey % 90)::int as age, c_custkey % 90 < 18 as minor, case when c_custkey % 2 = 0 then 'Lara' end as place from customer")
def demo_persons(spark, sf_dir):
    k = F.col("c_custkey")
    note = F.concat(F.lit("La familia demo busca  a "), F.lower("c_name"), F.lit(", "), (k % 90).cast("string"), F.lit(" años"), F.when(k % 2 == 0, ", Lara.").otherwise("."))
    read = pages.demo_persons(table(spark, sf_dir, "customer").select(note.alias("raw_content")))
    return read.select("full_name", F.col("age_range.min").alias("age"), F.col("is_minor").alias("minor"), F.col("last_known_location").alias("place"))


@query("select ['organizations', 'persons', 'locations', 'organizations'][c_custkey % 4 + 1] as bucket, case when c_custkey % 4 = 0 then 'Hospital ' else '' end || c_name as entity from customer")
def bucket_entities(spark, sf_dir):
    k = F.col("c_custkey")
    name = F.concat(F.when(k % 4 == 0, "Hospital ").otherwise(""), F.col("c_name"))
    rows = table(spark, sf_dir, "customer").select(name.alias("entity"), F.get(F.array(*[F.lit(x) for x in ("PER", "PER", "GPE", "ORG")]), (k % 4).cast("int")).alias("label"))
    return pages.bucket_entities(rows.unionByName(rows))


@query("select s_suppkey, n_nationkey / 10.0 as lat, n_regionkey / 10.0 as lng from supplier left join nation on s_nationkey = n_nationkey and n_nationkey < 20")
def geocoded(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    places = nation.where("n_nationkey < 20").select(F.lower("n_name").alias("place"), (F.col("n_nationkey") / 10.0).alias("lat"), (F.col("n_regionkey") / 10.0).alias("lng"))
    rows = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("last_known_location"))
    return location.geocoded(rows, places).select("s_suppkey", "lat", "lng")


@query("""select page_id, i as page, case when page_id % 4 < 2 then 2 else 1 end as total_pages, case when page_id % 4 < 2 then 't' || i end as title,
  case page_id % 4 when 2 then '<rss><item>page ' || page_id when 3 then '<!DOCTYPE x> <rss>' || page_id || '</rss>' else 't' || i || ' page ' || page_id || ' http://x.invalid/' || i end as text
from pages, (values (1), (2)) v(i) where page_id % 4 < 2 or i = 1""")
def feed_items(spark, sf_dir):
    """RSS, Atom, XML that is broken and XML with a document type, which is not parsed."""
    k = F.col("page_id").cast("string")
    item = lambda i: F.concat(F.lit(f"<item><title>t{i}</title><description>page "), k, F.lit(f"</description><link>http://x.invalid/{i}</link></item>"))
    entry = lambda i: F.concat(F.lit(f"<entry><title>t{i}</title><summary>page "), k, F.lit(f'</summary><link rel="self" href="x"/><link href="http://x.invalid/{i}"/></entry>'))
    bodies = (F.concat(F.lit("<rss><channel>"), item(1), item(2), F.lit("</channel></rss>")), F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom">'), entry(1), entry(2), F.lit("</feed>")), F.concat(F.lit("<rss><item>page "), k), F.concat(F.lit("<!DOCTYPE x>\n<rss>"), k, F.lit("</rss>")))
    feeds = table(spark, sf_dir, "pages").select("page_id", F.get(F.array(*bodies), (F.col("page_id") % 4).cast("int")).alias("body"))
    return pages.feed_items(feeds, key="page_id")


@query("select c_custkey::varchar as source_record_id, c_name as full_name, '****' || right(lpad(c_custkey::varchar, 9, '0'), 4) as cedula_masked, (c_custkey % 100)::int as age, 'missing' as status, '[id:' || c_custkey || '] d' as nota from customer where c_custkey % 7 <> 0")
def parse_api_pages(spark, sf_dir):
    k = F.col("c_custkey")
    item = F.struct(k.cast("string").alias("id"), F.when(k % 7 == 0, "").otherwise(F.col("c_name")).alias("nombre"), F.regexp_extract("c_name", r"(\d+)", 1).alias("cedula"), (k % 100).cast("string").alias("edad"), F.lit("Encontrada").alias("estado"), F.lit(" d ").alias("descripcion"))
    bodies = table(spark, sf_dir, "customer").groupBy((k % 64).alias("page")).agg(F.to_json(F.struct(F.collect_list(item).alias("items"))).alias("raw_content"))
    good, _ = pages.api_persons(bodies)
    return good.select("source_record_id", "full_name", "cedula_masked", F.col("age_range.min").alias("age"), "status", "nota")


# Incremental.


@query("select 's' || s as source_id, case when s = 1 then timestamp '1970-01-01' else strftime(max(ts) - interval 5 minute, '%Y-%m-%d %H:%M:%S')::timestamp end as watermark_at from (select event_id % 3 as s, date_trunc('second', ts) as ts from events) group by s")
def watermarks(spark, sf_dir):
    runs = table(spark, sf_dir, "events").select(F.concat(F.lit("s"), (F.col("event_id") % 3).cast("string")).alias("source_id"), F.date_trunc("second", F.col("ts").cast("timestamp")).alias("fetched_at"), F.lit(1).alias("sent"), F.when(F.col("event_id") % 3 == 1, 1).otherwise(0).alias("errors"))
    none = spark.createDataFrame([], "source_id string, watermark_at timestamp")
    return incremental.advance_watermarks(none, runs).withColumn("watermark_at", F.col("watermark_at").cast("timestamp_ntz"))


@query("select event_id from events where (ts, event_id) > (select max((ts, event_id)) from events where event_id < 1000)")
def delta_after_cursor(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.lit("e").alias("entity_type"), F.col("ts").cast("timestamp").alias("created_at"), F.col("event_id").alias("id"))
    return incremental.delta_after(rows, incremental.cursor_after(rows.where("id < 1000"))).select(F.col("id").alias("event_id"))


@query("select strftime(time_bucket(interval 1 hour, ts), '%Y-%m-%d %H') as hour, event_type, count(*) as n from events group by all")
def hourly_events(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("hour", F.date_format("ts", "yyyy-MM-dd HH"))
    return rows.groupBy("hour", "event_type").agg(F.count("*").alias("n"))


@query("select event_type as note, count(*) as n from events group by 1 order by n desc, note limit 5")
def top_notes(spark, sf_dir):
    """A report of the five commonest notices: the limit is the feature."""
    return provenance.commonest(table(spark, sf_dir, "events").select(F.col("event_type").alias("note")))
