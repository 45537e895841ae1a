"""Text, name and hash functions as column expressions; Unicode forms and metaphone as Arrow functions."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.functions import arrow_udf

#: What abbreviations of Venezuelan addresses stand for; each also occurs with a full stop.
ABBREVIATIONS = {
    "edo": "Estado", "mun": "Municipio", "av": "Avenida", "avda": "Avenida", "urb": "Urbanización", "pq": "Parque",
    "c/c": "Centro Comercial", "cc": "Centro Comercial", "dtto": "Distrito", "sect": "Sector", "blv": "Bulevar",
    "prol": "Prolongación", "esq": "Esquina", "qta": "Quinta", "res": "Residencias",
}
#: Words that stay in lower case inside a proper name.
CONNECTORS = ("de", "del", "la", "las", "los", "y", "e")
#: Honorifics that say nothing about identity.
HONORIFICS = ("sr", "sra", "srta", "don", "dona", "dr", "dra", "ing", "lic", "prof", "sor", "padre", "hermano", "hermana")


def _accents() -> tuple[str, str]:
    """All letters that decompose into one ASCII letter and marks, and those letters."""
    pairs = [(chr(c), base) for c in range(0xC0, 0x2000) if (base := "".join(x for x in unicodedata.normalize("NFD", chr(c)) if unicodedata.category(x) != "Mn")) != chr(c) and len(base) == 1 and base.isascii()]
    return "".join(p[0] for p in pairs), "".join(p[1] for p in pairs)


ACCENTED, PLAIN = _accents()
MARKS = "".join(chr(c) for block in (range(0x300, 0x370), range(0x1AB0, 0x1B00), range(0x1DC0, 0x1E00), range(0x20D0, 0x2100), range(0xFE20, 0xFE30)) for c in block)


def _compatible() -> dict[str, str]:
    """The letters and digits in lower case that each other character stands for in compatibility form, those of ACCENTED aside."""
    plain = lambda c: "".join(x if x.isascii() and x.isalnum() else "" if unicodedata.category(x) == "Mn" else " " for x in unicodedata.normalize("NFKD", c).lower())
    found = {chr(c): plain(chr(c)) for c in range(0x80, 0x20000) if not 0xD800 <= c < 0xE000 and unicodedata.decomposition(chr(c)).startswith("<")}
    return {c: v for c, v in found.items() if v.strip() and c not in ACCENTED}


_COMPATIBLE = _compatible()
#: Characters that stand for one letter or digit, those, and the others with what they stand for.
COMPATIBLE, COMPATIBLE_PLAIN = "".join(c for c, v in _COMPATIBLE.items() if len(v) == 1), "".join(v for v in _COMPATIBLE.values() if len(v) == 1)
LIGATURES = {c: v for c, v in _COMPATIBLE.items() if len(v) > 1}


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))


@arrow_udf(T.StringType())
def to_nfkc(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else unicodedata.normalize("NFKC", t) for t in texts.to_pylist()], pa.string())


def normalize_unicode(text: Column, form: str = "NFC") -> Column:
    """The text in a Unicode normal form, white space collapsed; null is empty."""

    @arrow_udf(T.StringType())
    def normal(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else unicodedata.normalize(form, t) for t in texts.to_pylist()], pa.string())

    return collapse(normal(text))


def normalize_text(text: Column) -> Column:
    """NFKC and collapsed white space; only texts with a character beyond ASCII are handed to Python."""
    odd = text.rlike(r"[^\x00-\x7F]")
    return collapse(F.when(odd, to_nfkc(F.when(odd, text))).otherwise(text))


def strip_accents(text: Column) -> Column:
    return F.translate(text, ACCENTED + MARKS, PLAIN)


def normalize_for_match(text: Column) -> Column:
    """Compatibility form in lower case without accents, anything but a-z and 0-9 as single spaces; null is empty. Without Python."""
    return F.trim(F.regexp_replace(strip_accents(F.lower(compatibility(F.coalesce(text, F.lit(""))))), r"[^a-z0-9]+", " "))


def compatibility(text: Column) -> Column:
    """The text with full-width, circled, styled and joined letters and digits written plainly; texts without any pass one search."""
    table = F.str_to_map(F.lit("\x1e".join(f"{c}\x1f{v}" for c, v in LIGATURES.items())), F.lit("\x1e"), F.lit("\x1f"))
    spelled = F.array_join(F.transform(F.split(F.translate(text, COMPATIBLE, COMPATIBLE_PLAIN), ""), lambda c: F.coalesce(F.try_element_at(table, c), c)), "")
    return F.when(text.rlike(_class(COMPATIBLE + "".join(LIGATURES))), spelled).otherwise(text)


def _class(chars: str) -> str:
    """A pattern of one of the characters, as ranges."""
    codes, out = sorted(map(ord, chars)), []
    for c in codes:
        if out and c == out[-1][1] + 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in out) + "]"


def load_abbreviations(path: str) -> dict[str, str]:
    """Abbreviation to word, in lower case, from a JSON object; ABBREVIATIONS where the file is missing or holds none."""
    import json
    from pathlib import Path

    file = Path(path)
    found = json.loads(file.read_text(encoding="utf-8")) if file.is_file() else None
    return {str(k).lower(): str(v) for k, v in found.items()} if isinstance(found, dict) and found else ABBREVIATIONS


def expand_abbreviations(text: Column, mapping: dict[str, str] = ABBREVIATIONS) -> Column:
    """Tokens looked up in lower case, with or without a final full stop; everything else stays, white space collapses."""
    table = F.create_map(*[F.lit(x) for k, v in mapping.items() for x in (k.lower(), v)])
    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?U)([\w/]+\.?|\s+|[^\w\s])"), F.lit(1))
    replaced = F.transform(tokens, lambda t: F.coalesce(F.try_element_at(table, F.lower(t)), F.try_element_at(table, F.regexp_replace(F.lower(t), r"\.$", "")), t))
    return collapse(F.array_join(replaced, ""))


def normalize_proper_name(name: Column) -> Column:
    def cased(word: Column, i: Column) -> Column:
        low = F.lower(word)
        return F.when((i > 0) & low.isin(*CONNECTORS), low).otherwise(F.concat(F.upper(F.substring(low, 1, 1)), F.substring(low, F.lit(2), F.length(low))))

    return F.array_join(F.transform(F.split(collapse(name), " "), cased), " ")


def normalize_person_name(name: Column) -> Column:
    return F.array_join(F.filter(F.split(normalize_for_match(name), " "), lambda t: ~t.isin(*HONORIFICS)), " ")


def name_key(name: Column) -> Column:
    return F.array_join(F.array_sort(F.split(normalize_person_name(name), " ")), " ")


def spanish_phonetic_key(name: Column) -> Column:
    key = strip_accents(F.replace(F.lower(F.trim(F.coalesce(name, F.lit("")))), F.lit("ñ"), F.lit("ni")))
    for old, new in (("ll", "y"), ("ch", "x"), ("rr", "r"), ("h", ""), ("b", "v"), ("z", "s"), ("c", "s"), ("g", "j")):
        key = F.replace(key, F.lit(old), F.lit(new))
    return F.regexp_replace(key, r"(?s)(.)\1+", "$1")


def short_hash(text: Column, digits: int = 16) -> Column:
    return F.substring(F.sha2(text, 256), 1, digits)


def metaphone(name: str) -> str:
    """A consonant key after Philips' published Double Metaphone rules, primary code, for lower-case names without accents.

    Written from the published description: initial silent pairs, the soft and hard forms of C, G, S, T
    and X, and one class for each group of like sounds; the four-sound limit is not applied.
    """
    s = "".join(c for c in name.upper() if "A" <= c <= "Z")
    out: list[str] = []
    i = 1 if s[:2] in ("GN", "KN", "PN", "WR", "PS") else 0
    vowel = lambda k: 0 <= k < len(s) and s[k] in "AEIOUY"
    while i < len(s):
        c, two, after = s[i], s[i : i + 2], s[i + 1 : i + 2]
        step, code = 1, ""
        if c in "AEIOUY":
            code = "A" if i == 0 else ""
        elif c == "B":
            code, step = "P", 2 if after == "B" else 1
        elif c == "C":
            if i == 0 and s[:6] == "CAESAR":
                code, step = "S", 2
            elif s[i : i + 4] == "CHIA" or (i > 0 and s[i : i + 4] == "CHAE"):
                code, step = "K", 2
            elif two == "CH":
                code, step = ("K" if s[i + 2 : i + 3] in ("R", "L") else "X"), 2
            elif s[i + 1 : i + 3] == "IA":
                code, step = "X", 3
            elif after and after in "EIY":
                code, step = "S", 2
            else:
                code, step = "K", 2 if after and after in "CKQ" and s[i + 1 : i + 3] not in ("CE", "CI") else 1
        elif c == "D":
            if two == "DG" and s[i + 2 : i + 3] and s[i + 2] in "EIY":
                code, step = "J", 3
            else:
                code, step = "T", 2 if after and after in "DT" else 1
        elif c == "G":
            if after == "H":
                rough = i > 2 and s[i - 1] == "U" and s[i - 3] in "CGLRT"
                code, step = ("K" if i == 0 or not vowel(i - 1) else "F" if rough else ""), 2
            elif after == "N":
                code, step = "N" if i else "KN", 2
            elif after and after in "EIY":
                code, step = "J", 2
            else:
                code, step = "K", 2 if after == "G" else 1
        elif c == "H":
            code, step = ("H", 2) if (i == 0 or vowel(i - 1)) and vowel(i + 1) else ("", 1)
        elif c == "J":
            code, step = ("H" if s[:4] == "JOSE" or s[:3] == "SAN" else "J"), 2 if after == "J" else 1
        elif c == "L":
            code, step = "L", 2 if after == "L" else 1
        elif c == "P":
            code, step = ("F", 2) if after == "H" else ("P", 2 if after and after in "PB" else 1)
        elif c == "Q":
            code, step = "K", 2 if after == "Q" else 1
        elif c == "S":
            if s[max(0, i - 1) : i + 2] in ("ISL", "YSL"):
                code = ""
            elif i == 0 and s[:5] == "SUGAR":
                code = "X"
            elif s[i : i + 3] == "SCH" and s[i + 3 : i + 5] not in ("OO", "ER", "EN", "UY", "ED", "EM"):
                code, step = "X", 3
            elif two == "SH" or s[i : i + 3] in ("SIO", "SIA"):
                code, step = "X" if two == "SH" else "S", 2 if two == "SH" else 3
            elif s[i : i + 3] == "SCH":
                code, step = "SK", 3
            elif two == "SC" and s[i + 2 : i + 3] and s[i + 2] in "EIY":
                code, step = "S", 3
            else:
                code, step = "S", 2 if after and after in "SZ" else 1
        elif c == "T":
            if s[i : i + 4] == "TION" or s[i : i + 3] in ("TIA", "TCH"):
                code, step = "X", 3
            elif two == "TH":
                code, step = "T" if s[i + 2 : i + 4] in ("OM", "AM") else "0", 2
            else:
                code, step = "T", 2 if after and after in "TD" else 1
        elif c == "V":
            code, step = "F", 2 if after == "V" else 1
        elif c == "W":
            code, step = ("R", 2) if two == "WR" else ("A" if i == 0 and (vowel(1) or two == "WH") else "", 1)
        elif c == "X":
            code, step = "S" if i == 0 else "KS", 2 if after and after in "CX" else 1
        elif c == "Z":
            code, step = ("J", 2) if after == "H" else ("S", 2 if after == "Z" else 1)
        elif c == "R" and i == len(s) - 1 and s[i - 2 : i] == "IE" and s[i - 4 : i - 2] not in ("ME", "MA"):
            pass
        else:
            code, step = {"F": "F", "K": "K", "M": "M", "N": "N", "R": "R"}[c], 2 if after == c else 1
        out.append(code)
        i += step
    return "".join(out)


@arrow_udf(T.StringType())
def _metaphone(names: pa.Array) -> pa.Array:
    return pa.array([None if n is None else metaphone(n) for n in names.to_pylist()], pa.string())


def phonetic_hash(name: Column) -> Column:
    """The metaphone code, else a hash of the Spanish key, else a hash of the name itself."""
    filled = F.coalesce(name, F.lit(""))
    code, key = _metaphone(strip_accents(F.lower(F.trim(filled)))), spanish_phonetic_key(filled)
    return F.when(code != "", code).when(key != "", short_hash(F.concat(F.lit("spa:"), key))).otherwise(short_hash(filled))


def deterministic_id(phonetic: Column, location: Column) -> Column:
    return F.when((phonetic != "") & (location != ""), short_hash(F.concat_ws("|", phonetic, location)))


def normalize_identifier(value: Column) -> Column:
    return F.replace(normalize_for_match(value), F.lit(" "), F.lit(""))


def plain_identifier(value: str) -> str:
    """normalize_identifier for one value in Python."""
    folded = unicodedata.normalize("NFKD", value).lower()
    return "".join(c for c in unicodedata.normalize("NFKD", folded) if c.isascii() and c.isalnum())


def hmac_sha256(message: Column, secret: str) -> Column:
    """HMAC-SHA256 in hex, by built-in functions; the padded keys are literals of the plan, so keep plans out of logs."""
    import hashlib

    key = secret.encode()
    key = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)
    return F.sha2(F.concat(F.lit(outer), F.unhex(F.sha2(F.concat(F.lit(inner), F.encode(message, "UTF-8")), 256))), 256)


def identity_token(value: Column, secret: str) -> Column:
    """The keyed token of an identifier, equal for all its spellings; null for empty ones. An empty secret is an error."""
    if not secret:
        raise ValueError("a secret is required to tokenise identifiers")
    normal = normalize_identifier(value)
    return F.when(normal != "", hmac_sha256(normal, secret))


def hmac_token(value: Column, secret: str) -> Column:
    return F.concat(F.lit("hmac_sha256:"), F.coalesce(identity_token(value, secret), F.lit("")))


def digits_only(value: Column) -> Column:
    return F.regexp_replace(F.coalesce(value, F.lit("")), r"(?U)\D+", "")


def mask_last4(value: Column) -> Column:
    """Asterisks and the last four digits; null below five digits."""
    digits = digits_only(value)
    return F.when(F.length(digits) >= 5, F.concat(F.lit("****"), F.right(digits, F.lit(4))))


def is_masked(value: Column) -> Column:
    return value.rlike("[•*]")


def preview(text: Column, most: int = 500) -> Column:
    return F.substring(text, 1, most)


def clean_page_text(text: Column) -> Column:
    return collapse(F.replace(text, F.lit("﻿"), F.lit("")))


def drop_leading_title(text: Column, title: Column) -> Column:
    return F.when(title.isNotNull() & (title != "") & F.startswith(text, title), F.trim(F.substring(text, F.length(title) + 1, F.length(text)))).otherwise(text)
