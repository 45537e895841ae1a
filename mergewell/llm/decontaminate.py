"""Benchmark decontamination by template windows; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mergewell.llm.common import free_name, join_small, text_key
from mergewell.session import cut_lineage, spread

WINDOW = 5
#: Share of an item's windows that one alignment with a document must hold.
OVERLAP = 0.8
#: Positions by which one alignment may shift from its first to its last window, for inserted or missing words.
DRIFT = 8
#: Tokens of a window that are no placeholders.
MIN_LITERALS = 3
#: More distinct benchmark windows than this are joined by a shuffle instead of a broadcast (about 100 bytes each).
BROADCAST_WINDOWS = 1_000_000
NUMBER, NAME, UNIT = "number", "name", "unit"
#: Units that count as such after a number.
UNITS = ("mm", "cm", "m", "km", "g", "kg", "mg", "t", "l", "ml", "s", "sec", "seconds", "min", "minutes", "h", "hours", "days", "weeks", "months", "years", "percent", "dollars", "euros", "usd", "eur", "inches", "feet", "miles", "pounds", "litres", "liters", "metres", "meters", "grams")
#: Characters of which tokens consist; a number written before or after others is a token of its own.
IN = r"\p{L}\p{M}\p{N}"
APART = f"[^{IN}]++"
BEFORE = f"(?<![{IN}])"
#: Adjacent capitalised words, and adjacent numbers, whatever stands between them. All loops are possessive: they never backtrack or recurse, however long a run is.
NAMES = rf"(?=\p{{Lu}}){BEFORE}\p{{Lu}}[{IN}]*+(?:{APART}\p{{Lu}}[{IN}]*+)*+"
NUMBERS = rf"(?=[0-9]){BEFORE}[0-9]++(?:{APART}[0-9]++)*+"
#: Stand for the placeholders within a text, as characters of their own.
MARKS = {NAME: "\x01", NUMBER: "\x02", UNIT: "\x03"}
MARKED = rf"{IN}\x01\x02\x03"
AFTER_NUMBER = rf"\x02 (?:{'|'.join(sorted(UNITS, key=len, reverse=True))})(?![^ ])"
#: WINDOW tokens from each token on, which alone is consumed.
GRAMS = rf"(?=((?:[^ ]++ ){{{WINDOW - 1}}}[^ ]++))[^ ]++ ?"


def _clean(text: Column) -> Column:
    """The text without characters that could pass for placeholders."""
    return F.translate(F.coalesce(text, F.lit("")), "\x01\x02\x03", "   ")


def canonical(body: Column) -> Column:
    """The template of a clean text: its tokens in lower case, one space apart, with runs of names, runs of numbers and units after a number replaced by one typed placeholder each.

    A text that has been lower-cased before has no names. Patterns run over the whole text, in the JVM.
    """
    named = F.regexp_replace(body, NAMES, f" {MARKS[NAME]} ")
    counted = F.regexp_replace(named, NUMBERS, f" {MARKS[NUMBER]} ")
    spaced = F.trim(F.regexp_replace(F.lower(counted), f"[^{MARKED}]++", " "))
    return F.regexp_replace(spaced, AFTER_NUMBER, f"{MARKS[NUMBER]} {MARKS[UNIT]}")


def _kinds(table: DataFrame, *keys: str) -> DataFrame:
    """(keys, kind, body) from (keys, body): kind 0 as it stands, kind 1 in lower case, so that copies match whatever their case."""
    kinds = F.array(F.struct(F.lit(0).alias("kind"), F.col("body")), F.struct(F.lit(1).alias("kind"), F.lower("body").alias("body")))
    return table.select(*keys, _clean(F.col("body")).alias("body")).select(*keys, F.explode(kinds).alias("x")).select(*keys, "x.kind", "x.body")


def _grams(table: DataFrame, *keys: str) -> DataFrame:
    """(keys, kind, p, gram) for the windows, by position, of the texts of (keys, kind, body)."""
    return table.select(*keys, "kind", F.posexplode(F.regexp_extract_all(canonical(F.col("body")), F.lit(GRAMS), F.lit(1))).alias("p", "gram"))


def _runs(table: DataFrame, *keys: str) -> DataFrame:
    """(keys, kind, runs): the words of the text, in an array, that each position of the template stands for."""
    words = F.regexp_extract_all(F.col("body"), F.lit(f"{NAMES}|{NUMBERS}|[{IN}]++"), F.lit(0))
    return table.select(*keys, "kind", F.transform(words, lambda w: F.split(F.regexp_replace(w, APART, " "), " ")).alias("runs"))


def _word() -> Column:
    """Hash of a window with its kind, for joins."""
    return F.xxhash64("kind", "gram")


def benchmark_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(item, kind, p, gram) for each window with enough literal tokens; (item, kind, windows, slots) for each form of an item that has any; (item, whole) for items that have none at all.

    slots are (p, value, mark, lone) of the placeholders, a value being the words of its run; lone ones
    lie in no window with enough literal tokens. Items that repeat exactly count once; items without a
    token are none.
    """
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("body")).where("item_id is not null").distinct()
    items = _kinds(items.select(F.struct("item_id", text_key(F.col("body")).alias("x")).alias("item"), "body"), "item")
    rows = 128 * benchmark.count()
    literal = F.size(F.filter(F.split("gram", " "), lambda t: ~t.isin(*MARKS.values())))
    windows = cut_lineage(_grams(items, "item").where(literal >= MIN_LITERALS), rows)
    counts = windows.groupBy("item", "kind").agg(F.count("*").alias("windows"), F.collect_list("p").alias("at"))
    forms = items.select("item", "kind", F.split(canonical(F.col("body")), " ").alias("form")).join(_runs(items, "item"), ["item", "kind"])
    lone = lambda i: ~F.exists("at", lambda p: (p <= i) & (i < p + WINDOW))
    slots = F.filter(F.transform("form", lambda t, i: F.when(t.isin(*MARKS.values()), F.struct(i.alias("p"), F.get("runs", i).alias("value"), t.alias("mark"), lone(i).alias("lone")))), lambda s: s.isNotNull())
    sized = cut_lineage(forms.join(counts, ["item", "kind"]).select("item", "kind", "windows", slots.alias("slots")), rows)
    short = items.where("kind = 1").join(windows.select("item").distinct(), "item", "left_anti")
    whole = short.select("item", _whole(F.col("body")).alias("whole")).where("whole <> ''")
    return windows, sized, cut_lineage(whole, rows)


#: Sets of an item's windows of which a text that holds OVERLAP of them cannot miss any.
PARTS = 4


#: Texts, drawn by hash, on which words are counted to tell rare ones; this decides only how many texts the first step lets through.
SAMPLED = 2000


def _words() -> Column:
    """The distinct words of a text that can be literal tokens of its windows."""
    return F.array_distinct(F.split(F.regexp_replace(F.lower(_clean(F.col("body"))), NUMBERS, " "), APART))


def _anchors(windows: DataFrame, keyed: DataFrame, total: int, rows: int, few: bool) -> DataFrame:
    """(a, form, bit, full): hashes of words of which a text that matches an item has one of every part; form is the hash of (item, kind).

    Each window stands for its rarest literal token in a sample of the texts. Of the windows whose tokens
    are rarest, up to PARTS sets are made, each of one more window than a match may lack: a match has a
    window of every set. bit is the set's, full that of all sets of the form.
    """
    literal = F.filter(F.split("gram", " "), lambda t: ~t.isin(*MARKS.values()))
    tokens = cut_lineage(windows.select("item", "kind", "p", F.explode(literal).alias("token")).withColumn("a", F.xxhash64("token")), 3 * rows)
    known = tokens.select("a").distinct()
    sample = keyed.where(F.pmod(F.xxhash64("body"), F.lit(max(1, total // SAMPLED))) == 0).select(F.explode(_words()).alias("word"))
    met = sample.select(F.xxhash64("word").alias("a")).join(F.broadcast(known) if few else known, "a", "left_semi").groupBy("a").agg(F.count("*").alias("texts"))
    rarity = F.struct(F.coalesce("texts", F.lit(0)).alias("texts"), (-F.length("token")).alias("short"), F.col("a").alias("a"))
    rarest = tokens.join(F.broadcast(met) if few else met, "a", "left").groupBy("item", "kind", "p").agg(F.min(rarity).alias("rarest"))
    form = Window.partitionBy("item", "kind")
    sized = rarest.withColumn("n", F.count("*").over(form)).withColumn("size", F.expr(f"n - (n * {round(OVERLAP * 10)} + 9) div 10 + 1"))
    parts = F.least(F.lit(PARTS).cast("long"), F.expr("n div size"))
    best = sized.withColumn("parts", parts).withColumn("rank", F.row_number().over(form.orderBy("rarest", "p"))).where(F.col("rank") <= F.col("parts") * F.col("size"))
    placed = best.withColumn("part", F.floor((F.row_number().over(form.orderBy("p")) - 1) / F.col("size")).cast("int"))
    return placed.select(F.col("rarest.a").alias("a"), F.xxhash64("item", "kind").alias("form"), F.expr("shiftleft(1, part)").alias("bit"), F.expr("shiftleft(1, int(parts)) - 1").alias("full")).distinct()


def _possible_texts(keyed: DataFrame, windows: DataFrame, total: int, rows: int, few: bool) -> DataFrame:
    """(th, kind, body), clean, once for each text of (th, body) and form that may hold an item; none that matches is missing.

    All texts are read for single words: a text must have an anchor of every part of an item. The words
    of those that do are then held against all windows of the item: no more windows than a match may
    lack can have a word that the text lacks. Only what is left is cut into windows.
    """
    anchors = cut_lineage(_anchors(windows, keyed, total, rows, few), rows)
    met = keyed.select("th", F.explode(_words()).alias("word")).select("th", F.xxhash64("word").alias("a")).join(F.broadcast(anchors) if few else anchors, "a")
    counted = met.groupBy("th", "form", "full").agg(F.bit_or("bit").alias("bits"))
    pairs = cut_lineage(counted.where("bits = full").select("th", "form"))
    texts = cut_lineage(join_small(keyed, cut_lineage(pairs.select("th").distinct()), "th", "left_semi").groupBy("th").agg(F.min("body").alias("body")))
    literal = F.filter(F.split("gram", " "), lambda t: ~t.isin(*MARKS.values()))
    forms = windows.groupBy("item", "kind").agg(F.collect_list(literal).alias("held")).withColumn("form", F.xxhash64("item", "kind"))
    sided = spread(pairs, pairs.count()).join(texts.select("th", _words().alias("words")), "th").join(forms, "form")
    missing = F.array(F.array_except(F.array_distinct(F.flatten("held")), "words"))
    lacking = F.get(F.transform(missing, lambda m: F.size(F.filter("held", lambda w: F.arrays_overlap(w, m)))), F.lit(0))
    wanted = cut_lineage(sided.where(F.size("held") - lacking >= F.size("held") * OVERLAP).select("th", "kind").distinct())
    return spread(cut_lineage(_kinds(texts, "th").join(wanted, ["th", "kind"], "left_semi")), wanted.count())


def _whole(lowered: Column) -> Column:
    """All tokens of a lower-cased text, one space apart."""
    return F.trim(F.regexp_replace(lowered, APART, " "))


def _slot_pairs(mine: Column, theirs: Column) -> Column:
    """Values that must stand for each other: word by word where both runs are as long, else run by run."""
    whole = F.array(F.struct(F.array_join(mine, " ").alias("mine"), F.array_join(theirs, " ").alias("theirs")))
    return F.when(F.size(mine) == F.size(theirs), F.zip_with(mine, theirs, lambda a, b: F.struct(a.alias("mine"), b.alias("theirs")))).otherwise(whole)


def contaminated_texts(documents: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """(th, item_id, matched, windows, same_slots): texts, by their identity, that hold OVERLAP of an item's windows in one alignment with consistent slots.

    Texts that lack a word of every part of each item are left out first, which loses no match. Windows
    of both sides are joined by hash and compared, never by pairs of documents and items. Matches
    are counted per text, item, form and distance between their positions, up to DRIFT apart, so
    scattered windows do not add up. Each slot value of the item that lies in a matched window must
    stand for one value in the text throughout the alignment. Slots of windows that did not match do not
    count; those that lie in no window at all do where the text has the same placeholder at their place. An alignment
    of one distance alone is tried as well. Items too short for a window with MIN_LITERALS literal
    tokens match texts of exactly their tokens, in any case. same_slots tells verbatim copies from
    re-parameterised ones. Null texts and texts without tokens match nothing, copies of a text count
    once, and empty tables give an empty result.
    """
    windows, items, short = benchmark_windows(benchmark)
    wanted, few = windows.select(_word().alias("w"), "item", "kind", "p", F.col("gram").alias("same")), windows.count() <= BROADCAST_WINDOWS
    sized = items.select("item", "kind", "windows")
    if few:
        wanted, sized, short = F.broadcast(wanted), F.broadcast(sized), F.broadcast(short)
    bodies = documents.where(F.col(text).isNotNull()).select(F.col(text).alias("body"))
    keyed = bodies.select(text_key(F.col("body")).alias("th"), "body")
    possible_texts = _possible_texts(keyed, windows, documents.count(), 128 * benchmark.count(), few)
    placed = _grams(possible_texts, "th").select("th", "kind", F.col("p").alias("q"), "gram")
    met = placed.withColumn("w", _word()).drop("kind").join(wanted, "w").where("gram = same").groupBy("th", "item", "kind", "p").agg(F.collect_set(F.col("q") - F.col("p")).alias("shifts"))
    held = met.groupBy("th", "item", "kind").agg(F.count("*").alias("found"), F.collect_list(F.struct("p", "shifts")).alias("places"))
    possible = cut_lineage(held.join(sized, ["item", "kind"]).where(F.col("found") >= F.col("windows") * OVERLAP).select("th", "item", "kind", "places", "windows"))
    places = possible.select("th", "item", "kind", "windows", F.explode("places").alias("x")).select("th", "item", "kind", "windows", "x.p", F.explode("x.shifts").alias("shift"))
    strength = places.groupBy("th", "item", "kind", "shift").agg(F.count("*").alias("strong"))
    weighed = places.join(strength, ["th", "item", "kind", "shift"])
    bases = F.array(F.struct(F.col("shift").alias("base"), F.lit(0).alias("drift")), *[F.struct((F.col("shift") - d).alias("base"), F.lit(DRIFT).alias("drift")) for d in range(DRIFT + 1)])
    spread = weighed.select("*", F.explode(bases).alias("b")).select("*", "b.base", "b.drift").groupBy("th", "item", "kind", "windows", "base", "drift", "p").agg(F.max(F.struct("strong", "shift")).alias("best"))
    enough = spread.groupBy("th", "item", "kind", "windows", "base", "drift").agg(F.count("*").alias("matched"), F.array_sort(F.collect_list(F.struct("p", F.col("best.shift").alias("shift")))).alias("path"))
    enough = cut_lineage(enough.where(F.col("matched") >= F.col("windows") * OVERLAP).dropDuplicates(["th", "item", "kind", "path"]))
    needed = enough.select("th").distinct()
    found_texts = possible_texts.join(needed, "th", "left_semi")
    copied = _runs(found_texts, "th").join(found_texts.select("th", "kind", F.split(canonical(F.col("body")), " ").alias("form")), ["th", "kind"])
    sided = enough.join(items.select("item", "kind", "slots"), ["item", "kind"]).join(copied, ["th", "kind"])
    slots = sided.select("th", "item", "kind", "base", "drift", "matched", "windows", "path", "runs", "form", F.explode_outer("slots").alias("slot"))
    covering = F.get(F.filter("path", lambda x: (x["p"] <= F.col("slot.p")) & (F.col("slot.p") < x["p"] + WINDOW)), F.lit(0))
    behind = F.filter("path", lambda x: x["p"] <= F.col("slot.p"))
    beside = F.coalesce(F.get(behind, F.size(behind) - 1), F.get("path", F.lit(0)))
    by_window, by_place = (F.col("slot.p") + covering["shift"]).cast("int"), (F.col("slot.p") + beside["shift"]).cast("int")
    theirs = F.when(covering.isNotNull(), F.get("runs", by_window)).when(F.col("slot.lone") & (F.get("form", by_place) == F.col("slot.mark")), F.get("runs", by_place))
    paired = slots.withColumn("theirs", theirs).withColumn("pairs", F.when(F.col("slot").isNotNull() & F.col("theirs").isNotNull(), _slot_pairs(F.col("slot.value"), F.col("theirs"))))
    gathered = paired.groupBy("th", "item", "kind", "base", "drift", "matched", "windows").agg(F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"))
    consistent = gathered.where(F.size(F.array_distinct(F.col("pairs.mine"))) == F.size("pairs"))
    verdict = consistent.withColumn("same", F.forall("pairs", lambda s: s["mine"] == s["theirs"]))
    found = verdict.groupBy("th", F.col("item.item_id").alias("item_id")).agg(F.max("matched").alias("matched"), F.max("windows").alias("windows"), F.max("same").alias("same_slots"))
    if short.isEmpty():
        return found
    exact = keyed.select("th", _whole(F.lower(_clean(F.col("body")))).alias("whole")).join(short, "whole").select("th", F.col("item.item_id").alias("item_id")).distinct()
    exact = exact.select("th", "item_id", F.lit(1).cast("long").alias("matched"), F.lit(1).cast("long").alias("windows"), F.lit(True).alias("same_slots"))
    return found.unionByName(exact.join(found.select("th", "item_id"), ["th", "item_id"], "left_anti"))


def decontamination_report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, contaminated, n_items, first_item) for every row of documents; null and clean texts hold no item, repeated rows are reported as often as they come."""
    found = contaminated_texts(documents, benchmark)
    by_text = cut_lineage(found.groupBy("th").agg(F.count("*").alias("n_items"), F.min("item_id").alias("first_item")))
    out = join_small(documents.select("doc_id", text_key(F.col("text")).alias("th")), by_text, "th")
    hit = F.col("n_items").isNotNull()
    return out.select("doc_id", hit.alias("contaminated"), F.when(hit, F.col("n_items")).otherwise(0).cast("long").alias("n_items"), F.when(hit, F.col("first_item")).alias("first_item"))


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """documents without those that hold a benchmark item; all other rows and all columns, whatever their names, stay as they are. Null and empty texts stay."""
    key = free_name(documents, "th")
    found = cut_lineage(contaminated_texts(documents, benchmark, text).select(F.col("th").alias(key)).distinct())
    return join_small(documents.withColumn(key, text_key(F.col(text))), found, key, "left_anti").select(*documents.columns)
