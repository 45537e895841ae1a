"""Web pages, feeds, JSON, plain files and posts as rows."""

from __future__ import annotations

import html.parser
import json
import re
import xml.etree.ElementTree as ElementTree
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.functions import arrow_udf

from mergewell.functions import scores, text

#: Elements without reading text.
SILENT = {"script", "style", "noscript", "nav", "footer", "header", "aside"}
PAGE = T.StructType([T.StructField("title", T.StringType()), T.StructField("text", T.StringType())])


class _Reader(html.parser.HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.silent: list[str] = []
        self.title: list[str] | None = None
        self.in_title = False
        self.parts: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag in SILENT:
            self.silent.append(tag)
        elif tag == "title" and self.title is None:
            self.title, self.in_title = [], True

    def handle_endtag(self, tag):
        if tag in self.silent:
            while self.silent.pop() != tag:
                pass
        elif tag == "title":
            self.in_title = False

    def handle_data(self, data):
        if self.in_title:
            self.title.append(data)
        if not self.silent:
            self.parts.append(data)


def read_html(source: str | None) -> dict:
    reader = _Reader()
    reader.feed(source or "")
    reader.close()
    squeeze = lambda parts: " ".join(" ".join(parts).split())
    return {"title": squeeze(reader.title) if reader.title else None, "text": squeeze(reader.parts)}


@arrow_udf(PAGE)
def html_page(sources: pa.Array) -> pa.Array:
    return pa.array([read_html(s) for s in sources.to_pylist()], pa.struct([("title", pa.string()), ("text", pa.string())]))


def html_pages(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """pages with html_title and body_text: visible text without a leading copy of the title."""
    read = pages.withColumn("__page", html_page(F.col(html_column)))
    body = text.drop_leading_title(text.clean_page_text(F.col("__page.text")), F.col("__page.title"))
    return read.withColumns({"html_title": F.col("__page.title"), "body_text": body}).drop("__page")


def read_feed(source: str | None) -> list[tuple[str | None, str]]:
    """(title, text) of each RSS item or Atom entry; anything that is no safe XML is one item of its raw text."""
    raw = source or ""
    if re.search(r"<!(?:DOCTYPE|ENTITY)", raw, re.IGNORECASE):
        return [(None, " ".join(raw.split()))]
    try:
        root = ElementTree.fromstring(raw.strip())
    except ElementTree.ParseError:
        return [(None, " ".join(raw.split()))]
    local = lambda e: e.tag.rpartition("}")[2]

    def said(item, *names: str) -> str:
        found = next((c for n in names for c in item if local(c) == n), None)
        return " ".join("".join(found.itertext()).split()) if found is not None else ""

    def link(item) -> str:
        links = [c for c in item if local(c) == "link"]
        best = next((c for c in links if c.get("rel", "alternate") == "alternate"), links[0] if links else None)
        return (best.get("href") or " ".join("".join(best.itertext()).split())) if best is not None else ""

    items = []
    for item in root.iter():
        if local(item) in ("item", "entry"):
            title = said(item, "title")
            items.append((title or None, " ".join(x for x in (title, said(item, "description", "summary", "content"), link(item)) if x)))
    return items or [(None, " ".join("".join(root.itertext()).split()))]


def feed_items(feeds: DataFrame, body: str = "body", key: str = "source_url") -> DataFrame:
    """(key, page, total_pages, title, text): a row for each item of each feed."""
    kind = feeds.schema[key].dataType.simpleString()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = [(k, i + 1, len(items), t, x) for k, b in zip(part[key], part[body]) for items in [read_feed(b)] for i, (t, x) in enumerate(items)]
            yield pd.DataFrame(rows, columns=[key, "page", "total_pages", "title", "text"])

    return feeds.select(key, body).mapInPandas(run, f"{key} {kind}, page int, total_pages int, title string, text string")


def flatten_json(source: str | None, most: int = 100) -> str:
    """`path: value` lines of a JSON document, at most 100 items of each list; empty and null values are left out."""
    out: list[str] = []

    def walk(value, path: str) -> None:
        if isinstance(value, dict):
            for k, v in value.items():
                walk(v, f"{path}.{k}" if path else str(k))
        elif isinstance(value, list):
            for i, v in enumerate(value[:most]):
                walk(v, f"{path}[{i}]")
        elif value is not None and value != "":
            out.append(f"{path}: {value}")

    try:
        walk(json.loads(source or "null"), "")
    except ValueError:
        return ""
    return "\n".join(out)


@arrow_udf(T.StringType())
def json_lines(sources: pa.Array) -> pa.Array:
    return pa.array([flatten_json(s) for s in sources.to_pylist()], pa.string())


def text_files(spark: SparkSession, path: str) -> DataFrame:
    """(source_url, raw_text): whole files, bytes that are no UTF-8 replaced."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("path").alias("source_url"), F.make_valid_utf8(F.col("content").cast("string")).alias("raw_text"))


def pdf_pages(spark: SparkSession, path: str, extract=None) -> tuple[DataFrame, DataFrame]:
    """(source_url, page, text) of PDF files and (source_url, reason_code) of those without text; extract turns bytes into page texts, and none is installed here."""
    if extract is None:
        raise RuntimeError("pass a function from bytes to page texts; no PDF library is installed")
    files = spark.read.format("binaryFile").load(path)

    @arrow_udf(T.ArrayType(T.StringType()))
    def pages(contents: pa.Array) -> pa.Array:
        return pa.array([[p for p in extract(c)] for c in contents.to_pylist()], pa.list_(pa.string()))

    read = files.select(F.col("path").alias("source_url"), F.transform(pages("content"), text.clean_page_text).alias("pages"))
    empty = F.forall("pages", lambda p: p == "")
    good = read.where(~empty).select("source_url", F.posexplode("pages").alias("page", "text")).withColumn("page", F.col("page") + 1)
    return good, read.where(empty).select("source_url", F.lit("pdf_no_text").alias("reason_code"))


#: The statuses of the persons API.
API_STATUS = {"desaparecido": "missing", "desaparecida": "missing", "encontrado": "missing", "encontrada": "missing", "herido": "missing", "herida": "missing", "fallecido": "deceased", "fallecida": "deceased", "muerto": "deceased", "muerta": "deceased", "sin_informacion": "unknown"}
API_PAGE = "struct<items:array<struct<id:string,nombre:string,cedula:string,edad:string,ultima_ubicacion:string,estado:string,descripcion:string,foto:string>>,total:int>"


def api_persons(pages: DataFrame, body: str = "raw_content") -> tuple[DataFrame, DataFrame]:
    """Persons of API pages, and what could not become one: unreadable pages and records without a name, each with a reason."""
    parsed = pages.withColumn("__p", F.from_json(body, API_PAGE))
    broken = parsed.where(F.col("__p.items").isNull()).select(F.col(body).alias("body"), F.lit("invalid_schema").alias("reason_code"))
    rows = parsed.select(F.explode("__p.items").alias("r"))
    nameless = rows.where(F.coalesce(F.trim("r.nombre"), F.lit("")) == "").select(F.to_json("r").alias("body"), F.lit("invalid_schema").alias("reason_code"))
    status = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for k, v in API_STATUS.items() for x in (k, v)]), F.lower(F.trim("r.estado"))), F.lit("unknown"))
    note = F.array_join(F.array_compact(F.array(F.when(F.col("r.id").isNotNull(), F.concat(F.lit("[id:"), F.col("r.id"), F.lit("]"))), F.nullif(F.trim("r.descripcion"), F.lit("")))), " ")
    good = rows.where(F.trim("r.nombre") != "").select(
        F.col("r.id").alias("source_record_id"), F.trim("r.nombre").alias("full_name"), F.when(~text.is_masked(F.col("r.cedula")), text.mask_last4(F.col("r.cedula"))).alias("cedula_masked"),
        F.when(text.is_masked(F.col("r.cedula")), F.col("r.cedula")).alias("unmapped_cedula"), scores.age_range(F.col("r.edad")).alias("age_range"),
        F.col("r.ultima_ubicacion").alias("last_known_location"), status.alias("status"), F.nullif(note, F.lit("")).alias("nota"), F.col("r.foto").alias("foto"),
    )
    return good, broken.unionByName(nameless)


#: Words of posts and the statuses they tell, first match first.
POST_STATUS = ((r"(?iuU)\b(desaparecid[oa]|se busca|no aparece)\b", "missing"), (r"(?iuU)\b(encontrad[oa]|apareci[oó]|localizad[oa])\b", "missing"), (r"(?iuU)\b(herid[oa]|lesionad[oa])\b", "missing"), (r"(?iuU)\b(fallecid[oa]|muri[oó])\b", "deceased"))
#: The shape of a name, what stands before or after it, and the words that end it.
POST_NAME = r"[A-ZÁÉÍÓÚÑ][A-Za-zÁÉÍÓÚÑáéíóúñ'-]+(?:\s+[A-ZÁÉÍÓÚÑ][A-Za-zÁÉÍÓÚÑáéíóúñ'-]+){1,4}"
AFTER_SIGNAL = rf"(?iu)\b(?:se busca|desaparecid[oa]|encontrad[oa]|herid[oa]|lesionad[oa]|fallecid[oa])\s+(?:a\s+)?({POST_NAME})"
BEFORE_STATUS = rf"(?iu)({POST_NAME})\s+(?:esta\s+|est[aá]\s+)?(?:desaparecid[oa]|encontrad[oa]|herid[oa]|lesionad[oa]|fallecid[oa])\b"
CONTEXT_WORDS = ("tras", "por", "en", "con", "durante", "luego", "y", "tlf", "celular", "contacto")


def post_status(body: Column) -> Column:
    return F.coalesce(*[F.when(body.rlike(p), F.lit(s)) for p, s in POST_STATUS])


def post_name(body: Column) -> Column:
    """The name after a signal word, else before a status word, in proper case, without the context words at its end; null where fewer than two of its words have more than one letter."""

    def shaped(pattern: str) -> Column:
        words = F.filter(F.split(F.regexp_extract(body, pattern, 1), r"\s+"), lambda w: w != "")
        last = F.array_max(F.transform(words, lambda w, i: F.when(~F.lower(w).isin(*CONTEXT_WORDS), i + 1)))
        name = text.normalize_proper_name(F.array_join(F.slice(words, F.lit(1), F.coalesce(last, F.lit(0))), " "))
        return F.when(F.size(F.filter(F.split(name, " "), lambda w: F.length(w) > 1)) >= 2, name)

    return F.coalesce(shaped(AFTER_SIGNAL), shaped(BEFORE_STATUS))


def posts(rows: DataFrame, body: str = "text") -> DataFrame:
    """rows with status and full_name read from posts; rows that tell neither keep nulls."""
    return rows.withColumns({"status": post_status(F.col(body)), "full_name": post_name(F.col(body))})


#: How the demonstration note names a person, an age and the one state it knows.
DEMO_NAME, DEMO_AGE, DEMO_STATE = r"(?iuU)\bFamilia\s+Demo\s+busca\s+a\s+([^,\n]+)", r"(?iuU)\b(\d{1,3})\s+a(?:ñ|n)os\b", "Lara"


def demo_persons(rows: DataFrame, body: str = "raw_content") -> DataFrame:
    """(full_name, age_range, is_minor, last_known_location, status, trust_tier) read from demonstration notes; notes without a name give no row."""
    name = text.normalize_proper_name(F.regexp_extract(body, DEMO_NAME, 1))
    ages = scores.age_range(F.nullif(F.regexp_extract(body, DEMO_AGE, 1), F.lit("")))
    read = rows.select(name.alias("full_name"), ages.alias("age_range"), F.when(F.contains(F.col(body), F.lit(DEMO_STATE)), DEMO_STATE).alias("last_known_location")).where("full_name <> ''")
    return read.select("full_name", "age_range", scores.is_minor(F.col("age_range")).alias("is_minor"), "last_known_location", F.lit("missing").alias("status"), F.lit("C").alias("trust_tier"))


def search_query(keywords: list[str], default: str) -> str:
    """Keywords joined by OR, phrases in quotes."""
    words = [f'"{k.strip()}"' if " " in k.strip() else k.strip() for k in keywords if k.strip()]
    return " OR ".join(words) or default


#: Words that make an entity an organisation, whatever its label.
ORGANISATION_WORDS = ("fundación", "fundacion", "hospital", "universidad", "cruz roja", "protección civil", "proteccion civil", "bomberos", "alcaldía", "alcaldia")


def bucket_entities(entities: DataFrame, label: str = "label", name: str = "entity") -> DataFrame:
    """(bucket, entity) of recognised entities, one for each normalised spelling; the recogniser itself is the caller's."""
    normal = text.normalize_for_match(F.col(name))
    organisation = F.exists(F.array(*[F.lit(w) for w in ORGANISATION_WORDS]), lambda w: F.contains(F.lower(F.col(name)), w))
    bucket = F.when(organisation, "organizations").when(F.col(label).isin("PER", "PERSON"), "persons").when(F.col(label).isin("LOC", "GPE"), "locations").when(F.col(label) == "ORG", "organizations")
    return entities.withColumns({"bucket": bucket, "__n": normal}).where("bucket is not null and __n <> ''").groupBy("bucket", "__n").agg(F.min(name).alias("entity")).drop("__n")
