"""Places of Venezuela: state and municipality of a free text."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from mergewell.functions.text import expand_abbreviations, normalize_for_match, normalize_text

#: The states.
STATES = (
    "Amazonas", "Anzoategui", "Apure", "Aragua", "Barinas", "Bolivar", "Carabobo", "Cojedes", "Delta Amacuro", "Dependencias Federales",
    "Distrito Capital", "Falcon", "Guarico", "La Guaira", "Lara", "Merida", "Miranda", "Monagas", "Nueva Esparta", "Portuguesa", "Sucre",
    "Tachira", "Trujillo", "Yaracuy", "Zulia",
)
#: Other names of states.
STATE_ALIASES = {"caracas": "Distrito Capital", "dtto capital": "Distrito Capital", "capital": "Distrito Capital", "vargas": "La Guaira"}
#: Municipalities, their states and further names.
MUNICIPALITIES = (
    ("Libertador", "Distrito Capital", ()), ("Chacao", "Miranda", ()), ("Baruta", "Miranda", ()), ("Sucre", "Miranda", ("petare",)),
    ("Maracaibo", "Zulia", ()), ("San Francisco", "Zulia", ()), ("San Felipe", "Yaracuy", ()), ("Independencia", "Yaracuy", ()),
    ("Iribarren", "Lara", ("barquisimeto",)), ("Moran", "Lara", ("el tocuyo",)), ("Valencia", "Carabobo", ()),
)
#: Colloquial spellings; callers pass a larger table where they have one.
SYNONYMS = {"catia": "catia la mar", "catita": "catia la mar", "guaira": "la guaira", "maxuto": "macuto"}


def load_synonyms(path: str) -> dict[str, str]:
    """Spelling to canonical name, both normalised, from a YAML file of `canonical: {name: [spellings]}`; the first name of a repeated spelling counts."""
    import yaml

    with open(path, encoding="utf-8") as file:
        listed = (yaml.safe_load(file) or {}).get("canonical") or {}
    out: dict[str, str] = {}
    for name, spellings in listed.items():
        for spelling in spellings or ():
            out.setdefault(_folded(str(spelling)), _folded(str(name)))
    return out


def _folded(name: str) -> str:
    plain = "".join(c if c.isascii() else " " for c in unicodedata.normalize("NFKD", name.lower()) if unicodedata.category(c) != "Mn")
    return " ".join("".join(c if c.isalnum() else " " for c in plain).split())


def state_names() -> list[tuple[str, str]]:
    """(name, state), longer names first, equal ones in order of the alphabet."""
    names = dict(STATE_ALIASES)
    for state in STATES:
        for lead in ("", "estado ", "edo "):
            names[lead + state.lower()] = state
    return sorted(names.items(), key=lambda x: (-len(x[0]), x[0]))


def _holds(text: Column, name: Column) -> Column:
    return F.contains(F.concat(F.lit(" "), text, F.lit(" ")), F.concat(F.lit(" "), name, F.lit(" ")))


def find_state(matched: Column) -> Column:
    """The state of the longest name that the text holds as whole words."""
    names = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(state).alias("state")) for name, state in state_names()])
    return F.get(F.filter(names, lambda n: _holds(matched, n["name"])), F.lit(0))["state"]


def find_municipality(matched: Column, state: Column) -> Column:
    """The only municipality named, within the state where one is known; null where several fit."""
    names = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(town).alias("town"), F.lit(of).alias("state")) for town, of, more in MUNICIPALITIES for n in (town.lower(), *more)])
    hits = F.array_distinct(F.transform(F.filter(names, lambda n: (state.isNull() | (n["state"] == state)) & _holds(matched, n["name"])), lambda n: n["town"]))
    return F.when(F.size(hits) == 1, F.get(hits, F.lit(0)))


def normalize_location(location: Column, synonyms: dict[str, str] = SYNONYMS, normal_text: bool = True) -> Column:
    """struct(raw, estado, municipio, parroquia, lat, lng); coordinates come from a join with a gazetteer, never from requests."""
    raw = normalize_text(location) if normal_text else F.trim(F.regexp_replace(F.coalesce(location, F.lit("")), r"(?U)\s+", " "))
    matched = normalize_for_match(expand_abbreviations(raw))
    if synonyms:
        table = F.str_to_map(F.lit("|".join(f"{k}:{v}" for k, v in synonyms.items())), F.lit("[|]"), F.lit(":"))  # one literal, however many spellings
        matched = F.get(F.transform(F.array(matched), lambda m: F.coalesce(F.try_element_at(table, m), m)), F.lit(0))
    towns = F.create_map(*[F.lit(x) for town, state, _ in MUNICIPALITIES for x in (town, state)])
    none = F.lit(None)

    def with_town(found: Column) -> Column:
        state = F.coalesce(found["state"], F.try_element_at(towns, found["town"]))
        town = F.when((state == "Distrito Capital") & found["town"].isNull(), F.lit("Libertador")).otherwise(found["town"])
        return F.struct(F.nullif(found["raw"], F.lit("")).alias("raw"), state.alias("estado"), town.alias("municipio"), none.cast("string").alias("parroquia"), none.cast("double").alias("lat"), none.cast("double").alias("lng"))

    # Each step is bound by a lambda, so that its text is computed once.
    seen = F.transform(F.array(F.struct(raw.alias("raw"), matched.alias("m"))), lambda x: F.struct(x["raw"].alias("raw"), x["m"].alias("m"), find_state(x["m"]).alias("state")))
    placed = F.transform(seen, lambda x: F.struct(x["raw"].alias("raw"), x["state"].alias("state"), find_municipality(x["m"], x["state"]).alias("town")))
    return F.get(F.transform(placed, with_town), F.lit(0))


def location_label(place: Column) -> Column:
    return F.coalesce(F.concat(place["municipio"], F.lit(", "), place["estado"]), place["estado"], place["raw"])


def city_and_state(label: Column) -> Column:
    """struct(city, state) split at the first comma; without a comma the state is empty."""
    city = normalize_for_match(F.split_part(label, F.lit(","), F.lit(1)))
    state = F.when(F.contains(label, F.lit(",")), normalize_for_match(F.substring(label, F.instr(label, ",") + 1, F.length(label)))).otherwise(F.lit(""))
    return F.struct(F.coalesce(city, F.lit("")).alias("city"), F.coalesce(state, F.lit("")).alias("state"))


def geocoded(df, gazetteer, label: str = "last_known_location"):
    """df with lat and lng looked up in (place, lat, lng); unknown places keep nulls."""
    return df.join(gazetteer.withColumnRenamed("place", "__place"), normalize_for_match(F.col(label)) == normalize_for_match(F.col("__place")), "left").drop("__place")
