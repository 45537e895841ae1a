"""Dates in Spanish and numeric notation, day first."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mergewell.functions.text import collapse, strip_accents

#: Month names and their abbreviations.
MONTHS = {
    "enero": 1, "ene": 1, "febrero": 2, "feb": 2, "marzo": 3, "mar": 3, "abril": 4, "abr": 4, "mayo": 5, "may": 5, "junio": 6, "jun": 6,
    "julio": 7, "jul": 7, "agosto": 8, "ago": 8, "septiembre": 9, "setiembre": 9, "sep": 9, "set": 9, "octubre": 10, "oct": 10,
    "noviembre": 11, "nov": 11, "diciembre": 12, "dic": 12,
}
_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2}))?"


def normalize_date(raw: Column) -> Column:
    """struct(value, start, end): an ISO date or date-time, or a month's first and last day; all null where nothing valid is written."""
    return F.get(F.transform(F.array(collapse(strip_accents(F.lower(raw)))), _parsed), F.lit(0))


def _parsed(text: Column) -> Column:
    """The struct for a cleaned text; bound by a lambda so that the text is computed once and the generated code stays small."""
    month_of = F.create_map(*[F.lit(x) for k, v in MONTHS.items() for x in (k, v)])

    def stamp(pattern: str, order: tuple[int, int, int], named: bool = False, utc: bool = False) -> Column:
        group = lambda k: F.regexp_extract(text, pattern, k)
        number = lambda k: group(k).try_cast("int")
        y, m, d = order
        month = F.try_element_at(month_of, group(m)) if named else number(m)
        hour = F.when(group(4) != "", group(4).try_cast("int"))
        minute, second = F.coalesce(group(5).try_cast("int"), F.lit(0)), F.coalesce(group(6).try_cast("int"), F.lit(0))
        valid = F.try_make_timestamp(group(y).try_cast("int"), month, group(d).try_cast("int"), F.coalesce(hour, F.lit(0)), minute, second.cast("decimal(8,6)"))
        shown = F.when(hour.isNull(), F.date_format(valid, "yyyy-MM-dd")).otherwise(F.concat(F.date_format(valid, "yyyy-MM-dd'T'HH:mm:ss"), F.when(group(7) == "z", F.lit("Z")).otherwise(F.lit("")) if utc else F.lit("")))
        return F.when(text.rlike(pattern) & valid.isNotNull() & (second < 60), shown)

    ymd = stamp(rf"^(\d{{4}})-(\d{{1,2}})-(\d{{1,2}})(?:[t ]{_TIME}(z)?)?$", (1, 2, 3), utc=True)
    dmy = stamp(rf"^(\d{{1,2}})[/-](\d{{1,2}})[/-](\d{{4}})(?: {_TIME})?$", (3, 2, 1))
    words = stamp(rf"^(\d{{1,2}}) (?:de )?([a-z]+) (?:de )?(\d{{4}})(?: {_TIME})?$", (3, 2, 1), named=True)
    numeric, named = r"^(\d{1,2})[/-](\d{4})$", r"^([a-z]+) (?:de )?(\d{4})$"
    month = F.when(text.rlike(numeric), F.regexp_extract(text, numeric, 1).try_cast("int")).when(text.rlike(named), F.try_element_at(month_of, F.regexp_extract(text, named, 1)))
    year = F.coalesce(F.nullif(F.regexp_extract(text, numeric, 2), F.lit("")), F.nullif(F.regexp_extract(text, named, 2), F.lit(""))).try_cast("int")
    start = F.when(month.between(1, 12), F.try_make_timestamp(year, month, F.lit(1), F.lit(0), F.lit(0), F.lit(0).cast("decimal(8,6)")).cast("date"))
    return F.struct(F.coalesce(ymd, dmy, words).alias("value"), start.alias("start"), F.last_day(start).alias("end"))


def truncate_to_hour(iso: Column) -> Column:
    """Date and hour in the value's own offset; empty where it is no ISO time."""
    shape = r"^(\d{4}-\d{2}-\d{2})(?:[T ](\d{2})(?::?\d{2}(?::?\d{2}(?:[.,]\d+)?)?)?(?:Z|[+-]\d{2}:?\d{2})?)?$"
    hour = F.regexp_extract(iso, shape, 2)
    valid = iso.rlike(shape) & F.try_to_date(F.substring(iso, 1, 10), "yyyy-MM-dd").isNotNull() & ((hour == "") | (hour < "24"))
    return F.when(valid, F.concat(F.regexp_extract(iso, shape, 1), F.lit("T"), F.when(hour == "", "00").otherwise(hour))).otherwise(F.lit(""))


def strip_fraction(iso: Column) -> Column:
    return F.when(F.contains(iso, F.lit(".")), F.concat(F.substring_index(iso, ".", 1), F.lit("Z"))).otherwise(iso)


def with_safety_margin(stamp: Column, minutes: int = 5) -> Column:
    return stamp - F.make_dt_interval(mins=F.lit(minutes))
