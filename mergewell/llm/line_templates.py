"""Line dedup with a log-template tree."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergewell.llm.common import BROADCAST_ROWS, free_name, join_small, text_key
from mergewell.session import cut_lineage, cut_scan

#: Leading tokens below the token count in the tree.
DEPTH = 3
#: Share of equal positions from which a line belongs to a template of its leaf.
SIMILARITY = 0.8
#: Leaves of more forms find their seeds through an index of token runs.
DIRECT = 64
#: Lines of fewer tokens are dropped only if they have this many characters.
MIN_TOKENS, MIN_CHARS = 3, 24
#: Lines of a leaf beyond which several tasks gather its templates, each with at most so many lines at a time; the templates are the same.
LEAF_FORMS = 20_000
#: Distinct texts from which a template is recurring: for lines of up to LONG tokens, and for longer ones, which count as passages: one repetition is enough for them.
MIN_DOCS, LONG, MIN_DOCS_LONG = 3, 50, 2
#: More leaves than this are joined by a shuffle instead of a broadcast (8 bytes each).
BROADCAST_LEAVES = 500_000
VARIABLE = "<*>"


def masked(line: Column) -> Column:
    """The line, trimmed, with runs of white space as one space and each token that holds a digit replaced by the variable mark.

    The patterns run only on lines that they change; plain searches for the characters come first.
    """
    odd = F.contains(line, F.lit("  ")) | line.startswith(" ") | line.endswith(" ")
    for char in ("\t", "\r", "\f", "\x0B"):
        odd = odd | F.contains(line, F.lit(char))
    clean = F.when(odd, F.trim(F.regexp_replace(line, r"[\t\x0B\f\r ]+", " "))).otherwise(line)
    return F.when(clean.rlike("[0-9]"), F.regexp_replace(clean, r"[^ ]*[0-9][^ ]*", VARIABLE)).otherwise(clean)


def _lines(documents: DataFrame, text: str, *fields: str) -> DataFrame:
    """(th, doc_id, pos, n, leaf) and the named of h and form, for the lines of all texts that have MIN_TOKENS or MIN_CHARS or more."""

    def described(form: Column) -> Column:
        n = F.length(form) - F.length(F.replace(form, F.lit(" "), F.lit(""))) + 1
        made = {"n": n, "leaf": F.xxhash64(n, F.substring_index(form, " ", DEPTH)), "h": F.xxhash64(form), "form": form}
        return F.struct(*[made[k].alias(k) for k in ("n", "leaf", *fields)], F.length(form).alias("size"))

    forms = F.transform(F.split(text, "\n"), masked)
    kept = F.filter(F.transform(forms, lambda f, i: F.struct(i.alias("pos"), described(f).alias("x"))), lambda line: (line["x"]["n"] >= MIN_TOKENS) | (line["x"]["size"] >= MIN_CHARS))
    keyed = documents.where(F.col(text).isNotNull()).select("doc_id", text_key(F.col(text)).alias("th"), text)  # below the explode: once a text, not once a line
    return keyed.select("th", "doc_id", F.explode(kept).alias("line")).select("th", "doc_id", "line.pos", "line.x.*").drop("size")


def _least() -> Column:
    """From how many texts a template of n tokens is recurring."""
    return F.when(F.col("n") > LONG, MIN_DOCS_LONG).otherwise(MIN_DOCS)


class _Seeds:
    """Forms of one length, found from lines that agree with them in SIMILARITY of their positions.

    So few positions may differ that, of one token run more than those, one is equal; runs leave out the
    leading tokens that a leaf shares.
    """

    def __init__(self, n: int):
        self.n, self.forms, self.runs = n, [], defaultdict(list)
        self.cuts = np.linspace(DEPTH, n, _spare(n) + 2).astype(int)

    def _keys(self, form: np.ndarray) -> list[tuple[int, bytes]]:
        return [(i, form[self.cuts[i] : self.cuts[i + 1]].tobytes()) for i in range(len(self.cuts) - 1)]

    def add(self, form: np.ndarray) -> None:
        for key in self._keys(form):
            self.runs[key].append(len(self.forms))
        self.forms.append(form)

    def find(self, form: np.ndarray) -> int | None:
        """The earliest form that this one agrees with."""
        near = sorted({i for key in self._keys(form) for i in self.runs.get(key, ())})
        for i in range(0, len(near), 4096):
            part = near[i : i + 4096]
            fits = np.flatnonzero((np.stack([self.forms[j] for j in part]) != form).sum(1) <= _spare(self.n))
            if len(fits):
                return part[fits[0]]
        return None


def _spare(n: int) -> int:
    """How many of n positions may differ."""
    return n - -(-n * round(SIMILARITY * 10) // 10)


def _commonest(forms: np.ndarray) -> np.ndarray:
    """The most frequent token of each position, ties by the larger hash."""
    if len(forms) <= 16:
        counts = (forms[:, None, :] == forms[None, :, :]).sum(1)
        return np.take_along_axis(forms, (counts * (1 << 33) + forms).argmax(0)[None, :], 0)[0]
    out = np.empty(forms.shape[1], forms.dtype)
    for i in range(forms.shape[1]):
        tokens, counts = np.unique(forms[:, i], return_counts=True)
        out[i] = tokens[np.flatnonzero(counts == counts.max())[-1]]
    return out


def _led(forms: np.ndarray) -> np.ndarray:
    """The first step of `gathered`: the row of the first form that each agrees with among those that agree with none before them."""
    m, n = forms.shape
    owner = np.arange(m)
    if m <= DIRECT:
        left = np.arange(m)
        while len(left):
            fits = (forms[left] != forms[left[0]]).sum(1) <= _spare(n)
            owner[left[fits]], left = left[0], left[~fits]
    else:
        seeds, rows = _Seeds(n), []
        for i in range(m):
            found = seeds.find(forms[i])
            if found is None:
                seeds.add(forms[i])
                rows.append(i)
            else:
                owner[i] = rows[found]
    return owner


def gathered(forms: np.ndarray) -> np.ndarray:
    """For the distinct forms of a leaf, the most frequent first, the row of the form whose template each follows.

    The first form not yet assigned is the next seed and takes all that agree with it, until none is left.
    Forms that stayed alone then join the commonest form of an earlier template, if they agree with
    that, and at last those that agree with their own commonest form join each other. `_gathered_apart`
    gives the same for leaves of any size.
    """
    m, n = forms.shape
    owner = _led(forms)
    sizes = np.bincount(owner, minlength=m)
    alone = np.flatnonzero(sizes[owner] == 1)
    large = np.flatnonzero(sizes > 2)
    if len(alone) and len(large):
        members = np.split(np.argsort(owner, kind="stable"), np.cumsum(sizes)[:-1])
        common = _Seeds(n)
        for i in large:
            common.add(_commonest(forms[members[i]]))
        for i in alone:
            found = common.find(forms[i])
            if found is not None:
                owner[i] = large[found]
        alone = alone[owner[alone] == alone]
    while len(alone) > 1:
        fits = (forms[alone] != _commonest(forms[alone])).sum(1) <= _spare(n)
        if fits.sum() < 2:
            break
        owner[alone[fits]], alone = alone[fits][0], alone[~fits]
    return owner


def _assigned(batches: Iterator[pa.RecordBatch], gather=gathered) -> Iterator[pa.RecordBatch]:
    """(h, template) of the forms that follow another one's template, from (h, leaf, tokens) sorted by leaf; a leaf is held at a time."""

    def closed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        h, forms = np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])
        owner = gather(forms)
        other = owner != np.arange(len(h))
        return h[other], h[owner[other]]

    held, at, out, size = [], None, [], 0
    for batch in batches:
        h, leaf = batch.column("h").to_numpy(), batch.column("leaf").to_numpy()
        lists = batch.column("tokens")
        ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        starts = np.flatnonzero(np.r_[True, leaf[1:] != leaf[:-1]]) if len(leaf) else []
        for i, j in zip(starts, [*starts[1:], len(leaf)]):
            if held and leaf[i] != at:
                out.append(closed(held))
                held, size = [], size + len(out[-1][0])
            at = leaf[i]
            held.append((h[i:j].copy(), flat[ends[i] : ends[j]].reshape(j - i, -1).copy()))
        if size > 10_000:
            yield _pairs(out)
            out, size = [], 0
    if held:
        out.append(closed(held))
    yield _pairs(out)


def _pairs(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    columns = [np.concatenate([np.zeros(0, np.int64)] + [p[i] for p in parts]) for i in (0, 1)]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["h", "template"])


def _following(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, template) of the rows with rest = 1 that agree with a seed (rest = 0), the earliest, from rows sorted by leaf, part, rest and rank."""
    at, seeds, names = None, None, []
    for batch in batches:
        columns = (batch.column(c).to_numpy() for c in ("h", "leaf", "part", "rest"))
        lists = batch.column("tokens")
        ends, flat, out = lists.offsets.to_numpy(), lists.values.to_numpy(), []
        for i, (h, leaf, part, rest) in enumerate(zip(*columns)):
            form = flat[ends[i] : ends[i + 1]]
            if (leaf, part) != at:
                at, seeds, names = (leaf, part), _Seeds(len(form)), []
            if rest:
                found = seeds.find(form)
                if found is not None:
                    out.append((h, names[found]))
            else:
                seeds.add(form.copy())
                names.append(h)
        h, template = np.array(out, np.int64).reshape(-1, 2).T
        yield _pairs([(h, template)])


def _rank() -> list[Column]:
    """The order of the forms of a leaf, the most frequent first."""
    return [F.desc("docs"), F.col("h")]


def _followed(seeds: DataFrame, rest: DataFrame, rows: int) -> DataFrame:
    """(h, template) of the rest that agrees with seeds of its leaf, the first by rank; both have (h, leaf, tokens, docs). Each task has the seeds and LEAF_FORMS or so of the rest."""
    parts = rest.groupBy("leaf").agg(F.ceil(F.count("*") / LEAF_FORMS).cast("int").alias("parts"))
    led = seeds.join(parts, "leaf").select("h", "leaf", "tokens", "docs", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("rest"))
    met = rest.join(parts, "leaf").select("h", "leaf", "tokens", "docs", F.pmod(F.xxhash64("h"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("rest"))
    sorted_ = led.unionByName(met).repartition("leaf", "part").sortWithinPartitions("leaf", "part", "rest", *_rank()).select("h", "leaf", "tokens", "part", "rest")
    return cut_lineage(sorted_.mapInArrow(_following, "h long, template long"), rows)


def _heads(forms: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """forms as those of each leaf that come first by rank, LEAF_FORMS of them at most, and the others."""
    ordered = forms.orderBy("leaf", *_rank()).withColumn("at", F.monotonically_increasing_id())
    # ids grow by one within a partition, whose number is in their bits from 33 on
    block = F.struct(F.shiftright("at", 33).alias("file"), F.floor(F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) / LEAF_FORMS).alias("part"))
    blocks = cut_lineage(ordered.withColumn("block", block).drop("at"), rows)
    first = blocks.groupBy("leaf").agg(F.min("block").alias("first"))
    split = blocks.join(first, "leaf")
    columns = forms.columns
    return split.where(F.col("block") == F.col("first")).select(*columns), split.where(F.col("block") != F.col("first")).select(*columns)


def _common(forms: DataFrame, *keys: str) -> DataFrame:
    """(keys, common): the most frequent token of each position, ties by the larger hash."""
    counts = forms.select(*keys, F.posexplode("tokens").alias("pos", "token")).groupBy(*keys, "pos", "token").agg(F.count("*").alias("n"))
    chosen = counts.groupBy(*keys, "pos").agg(F.max(F.struct("n", "token"))["token"].alias("token"))
    return chosen.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))), lambda x: x["token"]).alias("common"))


def _gathered_apart(forms: DataFrame, rows: int) -> DataFrame:
    """(h, template) as `gathered` assigns the forms of (h, leaf, tokens, docs) that follow another's template, without a leaf in one task.

    A form's seed is the first that it agrees with, and whether a form is a seed depends on those before
    it alone. So the first forms of a leaf are gathered in one task, the others are compared with the
    seeds found there, in as many tasks as they need, and what agrees with none goes on likewise. The
    forms that stay alone are then compared with the commonest forms, those of the first templates
    first, and at last with their own.
    """
    owned, left = None, forms
    while not left.isEmpty():
        head, others = _heads(left, rows)
        inner = head.repartition("leaf").sortWithinPartitions("leaf", *_rank()).select("h", "leaf", "tokens").mapInArrow(lambda x: _assigned(x, _led), "h long, template long")
        inner = cut_lineage(inner, rows)
        seeds = cut_lineage(head.join(inner, "h", "left_anti"), rows)
        outer = _followed(seeds, others, rows)
        found = inner.unionByName(outer).unionByName(seeds.select("h", F.col("h").alias("template")))
        owned = found if owned is None else owned.unionByName(found)
        left = cut_lineage(others.join(outer, "h", "left_anti"), rows)
    sizes = cut_lineage(owned.groupBy("template").agg(F.count("*").alias("n")), rows)
    taken = owned.where("h <> template")
    alone = cut_lineage(forms.join(sizes.where("n = 1").select(F.col("template").alias("h")), "h", "left_semi"), rows)
    members = forms.join(owned.join(sizes.where("n > 2"), "template"), "h").select("template", "tokens")
    common = forms.select("h", "leaf", "docs").join(_common(members, "template").withColumnRenamed("template", "h"), "h").select("h", "leaf", F.col("common").alias("tokens"), "docs")
    common = cut_lineage(common, rows)
    while not common.isEmpty():
        head, common = _heads(common, rows)
        met = _followed(head, alone, rows)
        taken, alone, common = taken.unionByName(met), cut_lineage(alone.join(met, "h", "left_anti"), rows), cut_lineage(common, rows)
    n = F.size("tokens")
    fits = F.size(F.filter(F.zip_with("tokens", "common", lambda a, b: a != b), lambda x: x)) <= n - F.floor((n * round(SIMILARITY * 10) + 9) / 10)
    while True:
        fit = alone.join(_common(alone, "leaf"), "leaf").where(fits)
        joined = fit.groupBy("leaf").agg(F.count("*").alias("n"), F.min_by("h", F.struct(-F.col("docs"), "h")).alias("template")).where("n > 1")
        met = cut_lineage(fit.join(joined, "leaf").select("h", "leaf", "template"), rows)
        if met.isEmpty():
            return taken
        taken = taken.unionByName(met.where("h <> template").select("h", "template"))
        alone = cut_lineage(alone.join(met.select("leaf").distinct(), "leaf", "left_semi").join(met, "h", "left_anti"), rows)


def _generalised(documents: DataFrame, text: str, stats: DataFrame, rows: int) -> DataFrame:
    """(h, template) for lines that follow the template of another line of their leaf; template is that line's h. Tokens are compared by their hashes."""
    leaves = stats.groupBy("leaf", "n").agg(F.count("*").alias("forms"), F.sum("docs").alias("docs")).where((F.col("forms") > 1) & (F.col("docs") >= _least())).where(f"n >= {next(n for n in range(1, 1000) if _spare(n))}").select("leaf", "forms")
    leaves = cut_lineage(leaves, rows)
    few = leaves.count() <= BROADCAST_LEAVES
    wanted = F.broadcast(leaves.select("leaf")) if few else leaves.select("leaf")
    met = _lines(documents, text, "form").select("leaf", "n", "form").join(wanted, "leaf", "left_semi")
    hashed = met.select(F.xxhash64("form").alias("h"), "leaf", F.transform(F.split("form", " "), lambda t: F.hash(t)).alias("tokens"))
    ranked = hashed.dropDuplicates(["h"]).join(stats.select("h", "docs"), "h").select("h", "leaf", "tokens", "docs")
    large = leaves.where(F.col("forms") > LEAF_FORMS).select("leaf")
    found = large.count()
    if found:
        ranked = cut_lineage(ranked, rows)
        large = F.broadcast(large) if found <= BROADCAST_ROWS else large
        apart = _gathered_apart(ranked.join(large, "leaf", "left_semi"), rows)
        ranked = ranked.join(large, "leaf", "left_anti")
    sorted_ = ranked.repartition("leaf").sortWithinPartitions("leaf", *_rank()).select("h", "leaf", "tokens")
    whole = cut_lineage(sorted_.mapInArrow(_assigned, "h long, template long"), rows)
    return whole.unionByName(apart) if found else whole


def _templates(documents: DataFrame, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The recurring templates, the lines that follow them, and (th, pos, h) of all lines."""
    lines = cut_scan(_lines(documents, text, "h").select("th", "doc_id", "pos", "h", "leaf", "n"), documents)
    rows = lines.count()
    per_text = lines.groupBy("h", "leaf", "n", "th").agg(F.min("doc_id").alias("doc_id"))
    stats = cut_lineage(per_text.groupBy("h", "leaf", "n").agg(F.count("*").alias("docs"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("first")), rows)
    joined = cut_lineage(stats.join(_generalised(documents, text, stats, rows), "h", "left").withColumn("template", F.coalesce("template", "h")).select("h", "n", "docs", "first", "template"), rows)
    shared = joined.groupBy("template").agg(F.count("*").alias("forms"), F.max("docs").alias("docs"), F.max("n").alias("n"), F.min("first").alias("first"), F.sum("docs").alias("sum"))
    shared = cut_lineage(shared.where(F.col("sum") >= _least()), rows)
    single = shared.where("forms = 1").select("template", "n", "docs", "first")
    several = shared.where("forms > 1").select("template", "n", "first")
    followers = joined.join(several.select("template"), "template", "left_semi").select("h", "template")
    exact = lines.select("h", "th").join(followers, "h").select("template", "th").distinct().groupBy("template").agg(F.count("*").alias("docs"))
    varied = several.join(exact, "template").select("template", "n", "docs", "first")
    recurring = single.unionByName(varied).where(F.col("docs") >= _least())
    recurring = cut_lineage(recurring.select("template", F.col("n").alias("tokens"), "docs", F.col("first.th").alias("first_th"), F.col("first.doc_id").alias("first_doc")), rows)
    return recurring, cut_lineage(joined.select("h", "template").join(recurring.select("template", "first_th"), "template"), rows), lines


def line_templates(documents: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The recurring templates, (template, tokens, docs, first_th, first_doc), and the lines that follow them, (h, template, first_th).

    A fixed-depth tree sends each line by its token count and its first DEPTH tokens to a leaf; tokens
    with digits count as variable. The most frequent line of a leaf and those that agree with it in
    SIMILARITY of their positions are one template, whose differing positions are variable; so are the
    most frequent of the others and those that agree with it, until no line is left (`gathered`). docs
    counts distinct texts, so copies of a whole document do not make its lines recur. All counts cover
    all lines; repeated lines are summed before they are shuffled.
    """
    recurring, lines, _ = _templates(documents, text)
    return recurring, lines


def drop_recurring_lines(documents: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """documents with every line of a recurring template removed but in the text where it comes first, and (th, drops): the line numbers removed from each text, th being its identity.

    First is the smallest document id (null last), then the smaller text hash; copies of that text keep
    the line too. All rows and columns, whatever their names, stay; a text that loses all lines becomes
    empty. Null, empty and unaffected texts stay exactly as they are; an empty table stays empty.
    """
    _, followers, lines = _templates(documents, text)
    marked = lines.select("th", "pos", "h").join(followers, "h").where("th <> first_th")
    marked = cut_lineage(marked.select("th", "pos"), lines.count())
    drops = cut_lineage(marked.groupBy("th").agg(F.collect_set("pos").alias("drops")), lines.count())
    key, gone = free_name(documents, "text_id"), free_name(documents, "drops")
    joined = join_small(documents.withColumn(key, text_key(F.col(text))), drops.select(F.col("th").alias(key), F.col("drops").alias(gone)), key, values=marked.count())
    # the lines are split once, and the numbers that stay are found by a set
    held = F.array(F.struct(F.split(text, "\n").alias("lines"), F.col(gone).alias("gone")))
    stays = F.transform(held, lambda x: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(x["lines"]) - 1), x["gone"]), lambda i: F.get(x["lines"], i)), "\n"))
    out = joined.withColumn(text, F.when(F.col(gone).isNull(), F.col(text)).otherwise(F.get(stays, F.lit(0))))
    return out.select(*documents.columns), drops


def line_report(documents: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_chars_left, text_sha256) for every document after the removal; a null text has no lines and stays null."""
    lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long")
    cleaned, _ = drop_recurring_lines(documents.select("doc_id", "text", lines.alias("n_lines")))
    return cleaned.select("doc_id", "n_lines", F.length("text").cast("long").alias("n_chars_left"), F.sha2("text", 256).alias("text_sha256"))
