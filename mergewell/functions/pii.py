"""Finding and redacting personal data."""

from __future__ import annotations

import hashlib
import hmac
import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.functions import arrow_udf

from mergewell.functions.text import plain_identifier

#: The kinds of findings and their patterns.
PATTERNS = {
    "identity_document": r"\b(?:[VEJG]\s*[-.]?\s*\d{6,10}|(?:DNI|CI|C[ÉE]DULA|RUT)\s*[:#-]?\s*\d{6,10})\b",
    "phone": r"(?:(?:\+?58|0058)[\s.-]?(?:0?4(?:12|14|16|24|26)|2\d{2})[\s.-]?\d{3}[\s.-]?\d{4}|\b0?4(?:12|14|16|24|26)[\s.-]?\d{3}[\s.-]?\d{4}\b|\b(?:tel[eé]fono|tlf|celular|m[oó]vil|whatsapp|contacto)\s*[:#-]?\s*(?:\+?\d[\d\s().-]{7,}\d))",
    "email": r"\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b",
    "possible_minor": r"\b(?:niñ[oa]|menor|adolescente|beb[ée]|infante)\b",
}
_COMPILED = {k: re.compile(p, re.IGNORECASE) for k, p in PATTERNS.items()}
SPANS = pa.list_(pa.struct([("kind", pa.string()), ("value", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def pii_count(text: Column, kind: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("(?iuU)" + PATTERNS[kind])), F.lit(0))


def pii_summary(text: Column) -> Column:
    """map of kind to number of findings; null where there are none."""
    counts = F.map_filter(F.create_map(*[x for k in PATTERNS for x in (F.lit(k), pii_count(text, k))]), lambda k, v: v > 0)
    return F.when(F.size(counts) > 0, counts)


def has_pii(text: Column) -> Column:
    return F.coalesce(text.rlike("(?iuU)" + "|".join(f"(?:{p})" for p in PATTERNS.values())), F.lit(False))


def spans(text: str) -> list[dict]:
    found = [{"kind": k, "value": m.group(0), "start": m.start(), "end": m.end()} for k, p in _COMPILED.items() for m in p.finditer(text or "")]
    return sorted(found, key=lambda f: f["start"])


@arrow_udf(T.ArrayType(T.StructType().add("kind", "string").add("value", "string").add("start", "integer").add("end", "integer")))
def detect_pii(texts: pa.Array) -> pa.Array:
    return pa.array([spans(t) for t in texts.to_pylist()], SPANS)


def redact(text: str, secret: str = "") -> str:
    """Findings as placeholders; overlapping ones become one of kind `pii`. Documents and phones carry the identity token of their text where a secret is set."""
    merged: list[list] = []
    for f in spans(text):
        if merged and f["start"] < merged[-1][2]:
            last = merged[-1]
            merged[-1] = ["pii", last[1], max(last[2], f["end"])]
        else:
            merged.append([f["kind"], f["start"], f["end"]])
    out, at = [], 0
    for kind, start, end in merged:
        token = ""
        if secret and kind in ("identity_document", "phone"):
            token = "_" + hmac.new(secret.encode(), plain_identifier(text[start:end]).encode(), hashlib.sha256).hexdigest()
        out += [text[at:start], f"[REDACTED_{kind.upper()}{token}]"]
        at = end
    return "".join(out) + text[at:]


def redact_pii(text: Column, secret: str = "") -> Column:
    @arrow_udf(T.StringType())
    def redacted(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else redact(t, secret) for t in texts.to_pylist()], pa.string())

    return redacted(text)
