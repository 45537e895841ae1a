"""Chat formatting in Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, COLON, NEXT, CLOSE = "### ", ": ", "<next>", "</turn>\n"
#: Each character that a control string needs, with its escape; the backslash comes first when escaping and last when reading.
ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"), (":", "\\c"))
TRAINED = "assistant"


def escape(text: Column) -> Column:
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def format_conversations(conversations: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """(conv_id, extra_keys, formatted, spans): one row per conversation; spans are the (start, length) in UTF-8 bytes of formatted that are trained on.

    Turn structs are collected and sorted by (turn, role, text); where the role changes a block begins,
    and the texts of its slice of turns are joined: `### role: text<next>text</turn>`. Spans are exactly
    the escaped assistant texts, no control string; their places are running sums of lengths, taken
    before a conversation's pieces are put together again under the same distribution, so there is one
    shuffle. Null texts and roles are empty; repeated rows are repeated turns; a null conv_id is a
    conversation like any other; an empty table gives an empty result. A conversation is one string, so
    it must fit a task. Byte places keep reading linear in the text's length.
    """
    keys = ["conv_id", *extra_keys]
    rows = conversations.select(*keys, F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    sorted_turns = rows.groupBy(*keys).agg(F.array_sort(F.collect_list("t")).alias("turns"))
    begins = F.filter(F.sequence(F.lit(0), F.size("turns") - 1), lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"]))
    marked = sorted_turns.withColumn("begins", begins)
    slices = F.transform("begins", lambda b, k: F.slice("turns", b + 1, F.coalesce(F.get("begins", k + 1), F.size("turns")) - b))

    def pieces(block: Column) -> Column:
        role = F.get(block, F.lit(0))["role"]
        texts = F.transform(block, lambda t, i: F.array(F.struct(F.when(i > 0, F.lit(NEXT)).otherwise(F.concat(F.lit(OPEN), escape(role), F.lit(COLON))).alias("s"), F.lit(False).alias("l")), F.struct(escape(t["text"]).alias("s"), (role == TRAINED).alias("l"))))
        return F.concat(F.flatten(texts), F.array(F.struct(F.lit(CLOSE).alias("s"), F.lit(False).alias("l"))))

    exploded = marked.select(*keys, F.posexplode(F.flatten(F.transform(slices, pieces))).alias("pos", "x"))
    before = Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    placed = exploded.select(*keys, "pos", "x.s", "x.l", F.octet_length("x.s").cast("long").alias("length")).withColumn("start", F.coalesce(F.sum("length").over(before), F.lit(0)))
    ordered = placed.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pos", "s"))).alias("p"), F.array_sort(F.collect_list(F.when(F.col("l"), F.struct("start", "length")))).alias("spans"))
    return ordered.select(*keys, F.array_join(F.transform("p", lambda x: x["s"]), "").alias("formatted"), "spans")


def read_turns(formatted: Column) -> Column:
    """The turns, as (role, text), that a formatted conversation holds, read from the string alone."""
    blocks = F.filter(F.split(formatted, CLOSE), lambda b: b != "")

    def turns(block: Column) -> Column:
        at = F.instr(block, COLON)
        role = unescape(F.substring(block, F.lit(len(OPEN) + 1), at - len(OPEN) - 1))
        body = F.substring(block, at + len(COLON), F.length(block))
        return F.transform(F.split(body, NEXT), lambda text: F.struct(role.alias("role"), unescape(text).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def trained_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, read from the formatted string by the places of the mask, unescaped and put together."""
    raw = formatted.cast("binary")
    return F.array_join(F.transform(spans, lambda x: unescape(F.substring(raw, (x["start"] + 1).cast("int"), x["length"].cast("int")).cast("string"))), "")
