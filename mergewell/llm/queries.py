"""The contract queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mergewell.llm import chat, decontaminate, hosts, line_templates, near_dup, quality, sharding, spots, tokens, toxicity
from mergewell.llm.common import remainder
from mergewell.session import spread

TOKENIZER = "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _scored(spark: SparkSession, sf_dir: str, train, threshold: float) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(documents, _table(spark, sf_dir, "labels"))
    scored = quality.score_texts(documents, model)
    return scored.select("doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; null and empty texts are scored as empty, repeated rows alike. An empty table gives an empty result."""
    return _scored(spark, sf_dir, quality.train_quality, 0.3)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 15 of every row, null and repeated ones included, under law `bytes`. An empty table gives an empty result."""
    return sharding.shard(_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; null and empty texts are scored as empty, repeated rows alike. An empty table gives an empty result."""
    return _scored(spark, sf_dir, toxicity.train_toxicity, 0.5)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each document holds a benchmark item; null and empty texts hold none, repeated rows and items count as often and once. Empty tables give an empty or a clean result."""
    return decontaminate.decontamination_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on each page; null urls have an empty host and path, labels with a null are no evidence. Empty tables give an empty result or allow."""
    return hosts.judge_pages(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; null and empty texts have fingerprint zero. An empty table gives an empty result."""
    found = near_dup.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line dedup leaves of each document; a null text has no lines and stays null. An empty table gives an empty result."""
    return line_templates.line_report(_table(spark, sf_dir, "documents"))


def op8_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each document and its edited text; a null text is empty, equal ids follow one another by text. An empty table gives an empty result."""
    return spots.edited_fingerprints(_table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of each whole text, as digests; a null text is empty. An empty table gives an empty result."""
    return tokens.tokenise(_table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted and read back; null texts and roles are empty, repeated rows are repeated turns. An empty table leaves the extra conversation."""
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text", F.lit(False).alias("extra")).unionByName(extra.withColumn("extra", F.lit(True)))
    made = chat.format_conversations(rows, ("extra",))  # apart from a conversation -7 that the table may hold
    read = made.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("trained", chat.trained_text(F.col("formatted"), F.col("spans")))
    body = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(body, 256).alias("turns_sha256"), F.length("trained").cast("long").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality, op2_sharding, op3_toxicity, op4_decontamination, op5_hosts, op6_simhash, op7_line_templates, op8_spotsigs, op9_sentencepiece, op10_chat, pipeline)}


def _escaped(column: str) -> str:
    return rf"replace(replace(replace(replace({column}, '\', '\b'), '#', '\h'), '<', '\l'), ':', '\c')"


OP10_SQL = rf"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text, false as extra from conversations
  union all values (-7, 0, 'user', '\### Assistant: </turn> ok', true), (-7, 1, 'assistant', '\### Assistant: </turn> ok', true)
), placed as (
  select *, lag(role) over w as before, lead(role) over w as after, row_number() over w as i from turns window w as (partition by conv_id, extra order by turn, role, text)
), pieces as (
  select *, case when before is not null and before = role then '<next>' else '### ' || {_escaped("role")} || ': ' end || {_escaped("text")}
    || case when after is null or after <> role then '</turn>' || chr(10) else '' end as piece from placed
)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by i) filter (where role = 'assistant'), '')) as loss_sha256,
  length(string_agg(piece, '' order by i)) as formatted_chars
from pieces group by conv_id, extra
"""


def _op4_sql() -> str:
    units = ", ".join(f"'{u}'" for u in decontaminate.UNITS)

    def form(raw: str) -> str:
        return f"""list_transform(range(1, len({raw}) + 1), lambda i: case
          when {raw}[i] >= '0' and {raw}[i] < ':' then '<number>'
          when lower({raw}[i]) in ({units}) and i > 1 and {raw}[i - 1] >= '0' and {raw}[i - 1] < ':' then '<unit>'
          when lower({raw}[i][1]) <> {raw}[i][1] then '<name>' else lower({raw}[i]) end)"""

    def raw(table: str, key: str) -> str:
        return f"select {key}, regexp_extract_all(coalesce(text, ''), '([0-9]+(?:[.,:][0-9]+)*|[\\p{{L}}\\p{{M}}\\p{{N}}]+)') as raw from {table}"

    return f"""
with item_raw as ({raw("(select distinct item_id, text from benchmark where item_id is not null)", "item_id, md5(coalesce(text, '')) as x")}),
item as (select item_id, x, raw, {form("raw")} as form from item_raw),
win as (
  select item_id, x, p, list_slice(form, p, p + 4) as w from (select *, unnest(range(1, len(form) - 3)) as p from item)
  where len(list_filter(list_slice(form, p, p + 4), lambda t: t not in ('<number>', '<name>', '<unit>'))) >= 3
),
total as (select item_id, x, count(*) as windows from win group by all),
doc_raw as ({raw("documents", "doc_id")}),
doc as (select doc_id, raw, {form("raw")} as form from doc_raw),
placed as (select doc_id, q, list_slice(form, q, q + 4) as w from (select doc_id, form, unnest(range(1, len(form) - 3)) as q from doc)),
aligned as (select doc_id, item_id, x, q - p as shift, count(distinct p) as matched from placed join win using (w) group by all),
enough as (select a.* from aligned a join total using (item_id, x) where matched >= windows * 0.8),
slots as (
  select e.doc_id, e.item_id, e.x, e.shift, i.raw[p] as mine, d.raw[p + shift] as theirs
  from enough e join (select item_id, x, raw, form, unnest(range(1, len(form) + 1)) as p from item) i using (item_id, x) join doc d using (doc_id)
  where i.form[p] in ('<number>', '<name>', '<unit>') and p + shift between 1 and len(d.raw)
),
clash as (select distinct doc_id, item_id, x, shift from (select doc_id, item_id, x, shift, mine from slots group by all having count(distinct theirs) > 1)),
hit as (select distinct doc_id, item_id from enough anti join clash using (doc_id, item_id, x, shift))
select doc_id, n_items is not null as contaminated, coalesce(n_items, 0)::bigint as n_items, first_item
from documents left join (select doc_id, count(*) as n_items, min(item_id) as first_item from hit group by doc_id) using (doc_id)
"""


def _op5_sql() -> str:
    two = ", ".join(f"'{s}'" for s in hosts.TWO_PART_SUFFIXES)
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in hosts.RULES)
    weight = f"""case when rate <= 0 or rate >= 1 or g < 2 then {hosts.WEIGHT_DEFAULT} when spread / n - rate * (1 - rate) * g / n <= 0 then {hosts.WEIGHT_HIGH}
      else least({hosts.WEIGHT_HIGH}, greatest({hosts.WEIGHT_LOW}, rate * (1 - rate) / (spread / n - rate * (1 - rate) * g / n) - 1)) end"""

    def level(name: str) -> str:
        return f"(select {weight} from (select count(*) as g, coalesce(sum(n), 1) as n, coalesce(sum(n * pow(bad / n - rate, 2)), 0) as spread, any_value(rate) as rate from {name}, rate where n > 1) t)"

    return rf"""
with part as (
  select page_id, case when contains(url, '://') then translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else '' end as host,
    case when contains(url, '://') then regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) else '' end as path from pages
), outcome as (
  select doc_id, avg(greatest(toxic, 1 - quality)::double) as y from labels where doc_id is not null and toxic is not null and quality is not null group by doc_id
), named as (
  select bare as host, y, string_split(bare, '.') as bits from (select *, regexp_replace(split_part(host, '@', -1), ':[0-9]*$', '') as bare from part) left join outcome on page_id = doc_id
), host as (
  select host, count(y) as n, coalesce(sum(y), 0.0) as bad, any_value(bits) as bits, array_to_string(any_value(bits)[-2:], '.') as two from named group by host
), cut as (
  select host, n, bad, case when two in ({two}) then two else bits[-1] end as suffix, case when two in ({two}) then array_to_string(bits[-3:], '.') else two end as domain from host
), dom as (select domain, suffix, sum(n) as n, sum(bad) as bad from cut group by all),
suf as (select suffix, sum(n) as n, sum(bad) as bad from dom group by all),
rate as (select case when sum(n) > 0 then sum(bad) / sum(n) else 0.0 end as rate from suf),
w as (select {level("suf")} as ws, {level("dom")} as wd, {level("cut")} as wh),
judged as (
  select host, n, wh, (cut.bad + (dom.bad + (suf.bad + rate * ws) / (suf.n + ws) * wd) / (dom.n + wd) * wh) / (cut.n + wh) as m, cut.n as hn
  from cut join dom using (domain, suffix) join suf using (suffix), rate, w
), blocked as (select host from judged where m - {hosts.DEVIATIONS} * sqrt(m * (1 - m) / (hn + wh + 1)) >= {hosts.BLOCK_FROM}),
ruled as (
  select page_id, arg_max(rh || rp, length(rh || rp)) as rule, arg_max(says, length(rh || rp)) as says
  from part join (values {rules}) r(rh, rp, says) on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp) group by page_id
)
select part.page_id, part.host, part.path, rule, coalesce(says, case when blocked.host is not null then 'block' else 'allow' end) as verdict
from part left join ruled using (page_id) left join blocked on regexp_replace(split_part(part.host, '@', -1), ':[0-9]*$', '') = blocked.host
""".replace("select host, n, wh, (cut", "select host, wh, (cut")


def oracle_sql() -> dict[str, str]:
    return {"op4_decontamination": _op4_sql(), "op5_hosts": _op5_sql(), "op10_chat": OP10_SQL}
