import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from mergewell.functions import dates, location, pii, scores, text


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(make(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("raw,want", [("  José  PÉREZ ", "jose perez"), (None, ""), ("Ñandú-Ágil 9", "nandu agil 9"), ("...", "")])
def test_match_text(spark, raw, want):
    assert one(spark, raw, text.normalize_for_match) == want


def test_unicode_forms(spark):
    assert one(spark, "ﬁn  ①", text.normalize_text) == "fin 1"
    assert one(spark, "é", lambda c: text.normalize_unicode(c, "NFC")) == "é"
    assert one(spark, None, text.normalize_text) == ""


@pytest.mark.parametrize("raw,want", [("Edo. Zulia, Mun. Maracaibo", "Estado Zulia, Municipio Maracaibo"), ("C/C  Sambil", "Centro Comercial Sambil"), ("casa", "casa"), (None, "")])
def test_abbreviations(spark, raw, want):
    assert one(spark, raw, text.expand_abbreviations) == want


def test_names(spark):
    assert one(spark, "JOSÉ  pérez de LA cruz", text.normalize_proper_name) == "José Pérez de la Cruz"
    assert one(spark, "Sra. María Díaz", text.normalize_person_name) == "maria diaz"
    assert one(spark, "Dr. Luis Ana", text.name_key) == "ana luis"
    assert one(spark, "Peña Llanos Chavez", text.spanish_phonetic_key) == "penia yanos xaves"
    same = [text.metaphone(n) for n in ("catherine", "katherine")]
    assert same[0] == same[1] and text.metaphone("knight") == "NT" and text.metaphone("") == ""
    assert one(spark, "", text.phonetic_hash) == hashlib.sha256(b"").hexdigest()[:16]


def test_identity(spark):
    want = hmac.new(b"k", b"v12345678", hashlib.sha256).hexdigest()
    for raw in ("V-12.345.678", "v 12345678", "V12345678"):
        assert one(spark, raw, lambda c: text.identity_token(c, "k")) == want
    assert one(spark, " ", lambda c: text.identity_token(c, "k")) is None
    with pytest.raises(ValueError):
        text.identity_token(F.lit("x"), "") if spark else None
    assert one(spark, "V-12.345.678", text.mask_last4) == "****5678" and one(spark, "123", text.mask_last4) is None


@pytest.mark.parametrize("raw,want", [
    ("24/6/2026", ("2026-06-24", None, None)), ("24-06-2026 7:05", ("2026-06-24T07:05:00", None, None)), ("2026-06-24T07:05:09Z", ("2026-06-24T07:05:09Z", None, None)),
    ("5 de Septiembre de 2026", ("2026-09-05", None, None)), ("2/2024", (None, "2024-02-01", "2024-02-29")), ("Enero de 2025", (None, "2025-01-01", "2025-01-31")),
    ("31/02/2026", (None, None, None)), ("13/2026", (None, None, None)), ("ayer", (None, None, None)), (None, (None, None, None)),
])
def test_dates(spark, raw, want):
    got = one(spark, raw, dates.normalize_date)
    assert (got["value"], got["start"] and str(got["start"]), got["end"] and str(got["end"])) == want


def test_hours(spark):
    assert one(spark, "2026-06-24T07:59:59-04:00", dates.truncate_to_hour) == "2026-06-24T07"
    assert one(spark, "2026-02-31T07:00:00", dates.truncate_to_hour) == "" and one(spark, "2026-06-24", dates.truncate_to_hour) == "2026-06-24T00"
    assert one(spark, "2026-06-24T07:00:00.123", dates.strip_fraction) == "2026-06-24T07:00:00Z"


@pytest.mark.parametrize("raw,estado,municipio", [("Petare, Edo. Miranda", "Miranda", "Sucre"), ("caracas", "Distrito Capital", "Libertador"), ("El Tocuyo", "Lara", "Moran"), ("Valencia o Maracaibo", None, None), (None, None, None)])
def test_places(spark, raw, estado, municipio):
    got = one(spark, raw, location.normalize_location)
    assert (got["estado"], got["municipio"]) == (estado, municipio)


def test_scores(spark):
    assert scores.jaro_winkler("martha", "marhta") == pytest.approx(0.961111, abs=1e-6) and scores.jaro_winkler("", "a") == 0.0
    ages = lambda a, b: spark.range(1).select(scores.age_score(*[F.struct(F.lit(x).alias("min"), F.lit(y).alias("max")) for x, y in (a, b)]).alias("y")).first()["y"]
    assert ages((10, 20), (15, 25)) == pytest.approx(1 / 3) and ages((30, 30), (30, 30)) == 0.0 and ages((1, 2), (5, 6)) == 0.0


def test_personal_data(spark):
    said = "Contacto: 0414-123.4567, V-12345678 o ana@mail.invalid, una niña"
    summary = one(spark, said, pii.pii_summary)
    assert {k: summary[k] for k in ("identity_document", "email", "possible_minor")} == {"identity_document": 1, "email": 1, "possible_minor": 1} and summary["phone"] >= 1
    shown = one(spark, said, pii.redact_pii)
    assert "@" not in shown and "12345678" not in shown and "niña" not in shown
    assert one(spark, "run 2026-06-24T10:00:00", pii.redact_pii) == "run 2026-06-24T10:00:00" and one(spark, None, pii.redact_pii) is None


def test_neighbouring_words_are_all_found(spark):
    """One space between two findings: the SQL of the plans takes it into the first and passes the second over."""
    said = "bebe Bebe bebé, niña menor"
    assert one(spark, said, pii.pii_summary) == {"possible_minor": 5} and len(one(spark, said, pii.detect_pii)) == 5
    assert one(spark, said, pii.redact_pii) == "{0} {0} {0}, {0} {0}".format("[REDACTED_POSSIBLE_MINOR]")
